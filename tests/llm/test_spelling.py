import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedback_spark.llm.queries import op11_spelling_variants
from feedback_spark.llm.spelling import group_variants, near_pairs, letters, one_edit, spelling_variants, word_counts

SF = "/root/testdata/sf0.001"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counted(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def grouped(words):
    out = {}
    short = {}
    for w in words:  # candidates share a deletion key
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            short.setdefault(k, set()).add(w)
    for w, n in words.items():
        cand = set().union(*(short.get(k, set()) for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))})) - {w}
        found = sorted((-words[x], x) for x in cand if near(w, x))
        form = found[0][1] if found and -found[0][0] >= 2 * n else None
        out[w] = [n, len(found), form, words[form] if form else None]
    for w in out:
        last = w
        while out[last][2]:
            last = out[last][2]
        out[w].append(last)
    return {w: tuple(v) for w, v in out.items()}


def rows(df):
    got = [(r["word"], (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])) for r in df.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = grouped(counted(docs))
    assert len(expected) > 300 and any(v[2] for v in expected.values())
    assert rows(op11_spelling_variants(spark, SF)) == expected


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (None, "Colour COLOUR colour colour colour colour color Color COLOR"), (3, "ÀÀÀÀÀ àààààà " * 4),
            (3, "ÀÀÀÀÀ àààààà " * 4), (4, "zz " * 50_000 + "straße Straße STRAßE strasse strasse strasse"), (5, "q" * 60_000 + " " + "q" * 60_001)]
    docs += [(6, docs[-1][1]), (7, docs[-1][1]), (8, docs[-1][1])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    assert rows(spelling_variants(df)) == grouped(counted(docs))


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert word_counts(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("tile", [7, 1024])
def test_crowded_cells_are_tiled(spark, tile):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("agms"), rng.integers(5, 8))) for _ in range(1500)} | {"aaaaa" + chr(0x10400 + k) for k in range(30)}
    words = {w: int(rng.integers(3, 60)) for w in words}  # groups of a, g, m, s coincide: very few cells
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(group_variants(df, tile=tile)) == grouped(words)


def test_long_chain_has_one_root(spark):
    words = {"abcde" + "f" * k: 3 * 2 ** k for k in range(30)}
    assert {r["root"] for r in group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()} == {"abcde" + "f" * 29}


def test_one_edit_on_rows():
    rng = np.random.default_rng(1)
    for la, lb in ((4, 4), (4, 5)):
        a, b = rng.integers(97, 99, (400, la)), rng.integers(97, 99, (400, lb))
        assert one_edit(a, b).tolist() == [near("".join(map(chr, x)), "".join(map(chr, y))) for x, y in zip(a, b)]


def test_gram_filter_keeps_every_near_pair():
    words = ["abcde", "abcdf", "abced", "xbcde", "bbcde"]
    i, j = near_pairs(letters("\n".join(words)), letters("\n".join(words)), True)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(5) for b in range(a + 1, 5) if near(words[a], words[b])]


def test_no_cross_join_in_the_plan(spark):
    df = spark.createDataFrame([("abcde", 3)], "word string, n long")
    plan = group_variants(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
