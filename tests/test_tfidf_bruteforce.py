"""F1 against a brute-force Python implementation of the same definition on a
small fixture (smoothed idf, L2 per document, n-grams after stop-word removal,
min document frequency, vocabulary cap by total term frequency)."""

import math
import re
from collections import Counter

from feedback_spark import fixed_values as FV
from feedback_spark.operators import phrases as PH

DOCS = [
    "The broker sync keeps failing and the csv import is broken again",
    "Broker sync failing; csv import broken, please add support for more brokers",
    "Great charts and great reports, the broker sync works fine now",
    "Reports are great but the mobile app crashes on every update",
    "Mobile app crashes after the update, reports missing, broker sync slow",
    "I love the charts. Reports and charts are great for my journal",
    "short",
]


def brute(texts, lo, hi, n, min_df=2, cap=5000):
    stops = set(FV.ENGLISH_STOP_WORDS)
    docs = []
    for t in texts:
        if len(t) <= FV.TFIDF_MIN_CHARS:
            continue
        toks = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in stops]
        grams = [" ".join(toks[i:i + k]) for k in range(lo, hi + 1) for i in range(len(toks) - k + 1)]
        docs.append(Counter(grams))
    N = len(docs)
    df = Counter(g for d in docs for g in d)
    ttf = Counter()
    for d in docs:
        ttf.update(d)
    vocab = sorted((g for g in df if df[g] >= min_df), key=lambda g: (-ttf[g], g))[:cap]
    idf = {g: math.log((1 + N) / (1 + df[g])) + 1 for g in vocab}
    score = Counter()
    for d in docs:
        w = {g: c * idf[g] for g, c in d.items() if g in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for g, v in w.items():
            score[g] += v / norm
    top = sorted(score, key=lambda g: (-round(score[g], 9), g))[:n]
    return [(g, int(score[g]), round(score[g], 6)) for g in top]


def test_top_phrases_matches_bruteforce(spark):
    df = spark.createDataFrame([("P", i, t) for i, t in enumerate(DOCS)], "product string, review_id long, review_text string")
    for lo, hi in ((1, 3), (2, 3)):
        got = [(r.phrase, r.score, r.weight) for r in
               PH.top_phrases(df, ["product"], 8, (lo, hi)).orderBy("rank").collect()]
        assert got == brute(DOCS, lo, hi, 8), (lo, hi)


def test_terms_are_counted_in_one_sort_and_no_text_is_cut_twice(spark):
    rows = [(g, i, t) for g in "PQ" for i, t in enumerate(DOCS * 2)] + [("P", 3, DOCS[0]), (None, 1, DOCS[1])]
    df = spark.createDataFrame(rows, "product string, review_id long, review_text string")
    for lo, hi in ((1, 1), (1, 2), (1, 3), (2, 3), (2, 4)):
        want = Counter()
        for g, i, t in rows:
            toks = [w for w in re.findall(r"\w{2,}", t.lower()) if w not in FV.ENGLISH_STOP_WORDS]
            want.update((g, i, " ".join(toks[k:k + m])) for m in range(lo, hi + 1) for k in range(len(toks) - m + 1))
        docs = Counter((g, t) for g, _, t in want)
        got = PH.term_counts(df, ["product"], (lo, hi), partitions=3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan, plan
        assert {((x.product, x.review_id, x.term), x.tf, x.df) for x in got.collect()} == {(k, c, docs[k[0], k[2]]) for k, c in want.items()}
