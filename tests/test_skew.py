"""Hot groups: exact results when one key holds a third of the rows."""

import random

from pyspark.sql import functions as F

from feedback_spark.functions.topk import top_k
from feedback_spark.operators.clean import dedup_first


def _rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randrange(40)}"
        rows.append((g, i, rnd.randrange(50)))
    return rows


def test_top_k_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, id long, v long")
    got = top_k(df, ["g"], [F.desc("v"), F.col("id")], 7)
    got = sorted((r.g, r.rank, r.id) for r in got.collect())
    want = []
    for g in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:7]
        want += [(g, i + 1, r[1]) for i, r in enumerate(grp)]
    assert got == sorted(want)


def test_dedup_with_hot_copy_group(spark):
    rows = [("P", i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "product string, review_id long, review_text string")
    out = dedup_first(df.repartition(16), ["product", "review_text"], ["review_id"])
    kept = {r.review_text: r.review_id for r in out.collect()}
    assert kept["same text"] == 0 and len(kept) == 1 + 2000


def test_numbering_by_group_moves_no_group_to_one_task(spark, monkeypatch):
    from feedback_spark.operators import clean as C

    rows = [("P" if i % 3 else "Q", i, f"text {i}") for i in range(600)] + [(None, 7, "x")]
    df = spark.createDataFrame(rows, "product string, review_id long, review_text string").repartition(5)
    out = C.with_seq(df, ["product", "review_id"], group=["product"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(product" not in plan, plan
    want = sorted((g, i, n + 1) for g in "PQ" for n, i in enumerate(sorted(r[1] for r in rows if r[0] == g)))
    got = lambda d: sorted((r.product, r.review_id, r.review_seq) for r in d.collect())
    assert got(out) == want
    monkeypatch.setattr(C, "MOST_SENT", 1)
    assert got(C.with_seq(df, ["product", "review_id"], group=["product"])) == want
