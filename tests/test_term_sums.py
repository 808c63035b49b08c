"""F1 on little disk: terms counted in passes, shuffle files dropped after each, against brute force and odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedback_spark import fixed_values as FV
from feedback_spark.operators import phrases as PH
from feedback_spark.operators import term_sums as TS


def brute(rows, lo, hi, n, min_df=2, min_docs=FV.TFIDF_MIN_DOCS):
    """(group, rank, phrase, weight); rows with the same group and id are one document."""
    docs = defaultdict(Counter)
    for g, i, t in rows:
        if g is None or t is None or len(t) <= FV.TFIDF_MIN_CHARS:
            continue
        toks = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in FV.ENGLISH_STOP_WORDS]
        docs[g, i].update(" ".join(toks[k:k + m]) for m in range(lo, hi + 1) for k in range(len(toks) - m + 1))
    size = Counter(g for g, _ in docs)
    df = Counter((g, t) for (g, _), c in docs.items() for t in c)
    sums = Counter()
    for (g, _), c in docs.items():
        w = {t: x * (math.log((1 + size[g]) / (1 + df[g, t])) + 1) for t, x in c.items() if df[g, t] >= min_df}
        norm = math.sqrt(sum(x * x for x in w.values()))
        sums.update({(g, t): x / norm for t, x in w.items()})
    out = []
    for g in (g for g in size if size[g] >= min_docs):
        top = sorted((-round(s, 9), t) for (h, t), s in sums.items() if h == g)[:n]
        out += [(g, k, t, round(-s, 6)) for k, (s, t) in enumerate(top, 1)]
    return sorted(out)


def made(seed=1, docs=120):
    rnd, words = random.Random(seed), [f"word{i}" for i in range(60)] + ["größe", "日本語", "naïve"]
    return [(rnd.choice(["P", "Q", "R"]), i, " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 60)))) for i in range(docs)]


ODD = {
    "plain": lambda rows: rows,
    "ids that repeat": lambda rows: [(g, i % 40, t) for g, i, t in rows] + rows[:7] + rows[:3],
    "ids that are null": lambda rows: [(g, None if i % 5 == 0 else i, t) for g, i, t in rows] + [(None, 1, rows[0][2]), ("P", 2, None)],
    "small groups and empty texts": lambda rows: [*rows, ("S", 1, rows[0][2]), ("P", 900, "-" * 40), ("P", 901, "")],
    "ties": lambda rows: [("P", i, "alpha beta gamma delta epsilon") for i in range(8)] + rows,
}


@pytest.mark.parametrize("kind", ODD)
def test_passes_give_the_sums_of_brute_force(spark, monkeypatch, kind):
    for name, value in (("TERMS_A_PASS", 700), ("MOST_PASSES", 3), ("NORMS_AT_ONCE", 30), ("NAMES_AT_ONCE", 9)):
        monkeypatch.setattr(TS, name, value)
    rows = ODD[kind](made())
    df = spark.createDataFrame(rows, "product string, review_id long, review_text string").repartition(4)
    for lo, hi, n in ((2, 3, 4),) if kind == "plain" else ((1, 3, 6),):
        got = PH.top_phrases(df, ["product"], n, (lo, hi), partitions=3).filter("method = 'tfidf'")
        assert sorted((r["product"], r["rank"], r["phrase"], r["weight"]) for r in got.collect()) == brute(rows, lo, hi, n)


def test_text_ids(spark):
    rows = [(g, i % 50, t) for g, i, t in made(2)]
    df = spark.createDataFrame([(g, f"id-{i}", t) for g, i, t in rows], "product string, review_id string, review_text string")
    got = PH.top_phrases(df, ["product"], 5, (1, 2)).filter("method = 'tfidf'").collect()
    assert sorted((r["product"], r["rank"], r["phrase"], r["weight"]) for r in got) == brute(rows, 1, 2, 5)


def test_counting_leaves_less_on_disk_than_the_texts(spark):
    rnd = random.Random(3)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.6)) % 5000}" for _ in range(400)) for _ in range(600)]
    df = spark.createDataFrame([("P", i, t) for i, t in enumerate(texts)], "product string, review_id long, review_text string").repartition(4)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    before = shuffled()
    assert PH.top_phrases(df, ["product"], 10, (1, 3), partitions=4).count() == 10
    left = sum(size for name, size in shuffled().items() if name not in before)
    assert left < sum(map(len, texts)) / 2, left


def test_digests_do_not_depend_on_runs(monkeypatch):
    rnd = np.random.default_rng(0)
    block = TS.Block(*TS.coded(rnd.integers(0, 9, 100).astype(np.uint64), np.zeros(100, np.uint32)), np.arange(10), np.full(10, 10))
    once = {(n, first + i): d for n, first, x, ok in block.digests(1, 4) for i, (d, o) in enumerate(zip(x.tolist(), ok, strict=True)) if o}
    monkeypatch.setattr(TS, "CHUNK", 7)
    again = {(n, first + i): d for n, first, x, ok in block.digests(1, 4) for i, (d, o) in enumerate(zip(x.tolist(), ok, strict=True)) if o}
    assert once == again and len(once) == 100 + 90 + 80 + 70


def test_words_and_terms_with_equal_first_digests_stay_apart():
    h1, h2 = np.array([5, 5, 7, 5], np.uint64), np.array([1, 2, 1, 1], np.uint32)
    w1, w2, codes = TS.coded(h1, h2)
    assert (w1[codes] == h1).all() and (w2[codes] == h2).all() and len(w1) == 3
    k1, k2, doc = np.array([4, 4, 4, 4], np.uint64), np.array([1, 2, 1, 2], np.uint32), np.array([0, 0, 1, 1], np.uint64)
    order = TS._by_term(k1, k2, doc)
    assert k2[order].tolist() == [1, 1, 2, 2] and doc[order].tolist() == [0, 1, 0, 1]


def test_passes_part_the_digests():
    k1 = np.sort(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    k1[0], k1[-1] = 0, 2**64 - 1
    for passes, cells in ((1, 1), (3, 4), (16, 28)):
        inside = [TS.Pass(i, passes, cells).inside(k1) for i in range(passes)]
        assert (np.sum(inside, axis=0) == 1).all()
        for i, x in enumerate(inside):
            bounds = TS.Pass(i, passes, cells).bounds(k1[x])
            assert bounds[0] == 0 and bounds[-1] == x.sum() and (np.diff(bounds) >= 0).all()
