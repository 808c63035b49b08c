import random

import pytest
from pyspark.sql import functions as F

from feedback_spark.llm.packing import CAPACITIES, OVERHEAD, best_fit, best_fit_pack, pack, word_count
from feedback_spark.llm.queries import op8_best_fit_packing

SF = "/root/testdata/sf0.01"


def brute_best_fit(lengths, size):
    """Best fit by looking at every open bin."""
    space = []
    for n in lengths:
        fits = [s for s in space if s >= n]
        if fits:
            space[space.index(min(fits))] -= n
        else:
            space.append(size - n)
    return sorted(size - s for s in space)


@pytest.mark.parametrize("seed", range(3))
def test_best_fit_agrees_with_brute_force(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    bins, used = best_fit(lengths, [100], lambda i: 100)
    assert sorted(used) == brute_best_fit(lengths, 100)
    assert len(bins) == 300 and max(used) <= 100


def test_pack_takes_the_cheapest_rule_and_downsizes():
    rng = random.Random(1)
    lengths = sorted((min(8192, int(rng.paretovariate(1.1) * 150)) for _ in range(2000)), reverse=True)
    bins, used, final = pack(lengths, CAPACITIES, OVERHEAD)
    assert sum(used) == sum(lengths) and all(u <= c for u, c in zip(used, final, strict=True))
    assert all(c == min(x for x in CAPACITIES if x >= u) for u, c in zip(used, final, strict=True))
    cost = sum(final) + OVERHEAD * len(final)
    for c in CAPACITIES:
        one = brute_best_fit([min(n, 8192) for n in lengths], 8192) if c == 8192 else None
        assert one is None or cost <= 8192 * len(one) + OVERHEAD * len(one)
    assert sum(used) / sum(final) > 0.97
    assert pack([5], (4096, 512), 16)[2] == [512]


def check(rows, docs, capacities):
    by = {}
    for r in rows:
        if r["bin"] is None:
            assert r["n_tokens"] == 0 and r["capacity"] is None
            continue
        by.setdefault(r["bin"], []).append(r)
    for items in by.values():
        cap = {r["capacity"] for r in items}
        used = sum(r["n_tokens"] for r in items)
        assert len(cap) == 1 and cap == {min(c for c in capacities if c >= used)}
        at = 0
        for r in sorted(items, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["n_tokens"]
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
    assert got == docs


def test_edges(spark):
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "w " * 100), (4, "w " * 23)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bin string")
    got = best_fit_pack(docs, word_count(F.col("text")), capacities=(8, 16), shard_items=2).collect()
    check(got, {1: 4, None: 0, 2: 0, 3: 100, 4: 23}, (8, 16))
    assert len([r for r in got if r["doc_id"] == 1]) == 2
    assert sorted((r["piece"], r["start"], r["n_tokens"]) for r in got if r["doc_id"] == 4) == [(0, 0, 16), (1, 16, 7)]
    assert best_fit_pack(docs.limit(0), word_count(F.col("text"))).count() == 0


def test_query_keeps_every_token(spark):
    docs = {r["doc_id"]: len((r["text"] or "").split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(op8_best_fit_packing(spark, SF).collect(), docs, CAPACITIES)
