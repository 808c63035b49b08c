"""Connected components of an edge table by rounds of random contraction.

Each round every node moves to its neighbour of least priority (or stays), and
the edges are rewritten between the places moved to.  A new random order in
each round makes chains and stars alike shrink by a constant factor, so the
number of rounds grows with the logarithm of the longest component.  Minima are
combined map-side, so a hub's edges never meet in one task; the joins are plain
equi-joins that adaptive execution can split.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise


def components(edges: DataFrame, rows: int | None = None, seed: int = 5) -> DataFrame:
    """``edges``: a, b (long); ``rows``: about how many there are at most.

    Returns node, root for every node that has an edge; no edges, no rows.
    """
    rng = random.Random(seed)
    left = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", rows=rows)
    n = left.count()
    labels = None
    while labels is None or n:
        order = F.lit(rng.getrandbits(64) - (1 << 63))
        both = left.select(F.col("a").alias("node"), F.col("b").bitwiseXOR(order).alias("rank")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").bitwiseXOR(order).alias("rank")))
        moved = materialise(both.groupBy("node").agg(F.min("rank").alias("rank")).select(
            "node", F.least("rank", F.col("node").bitwiseXOR(order)).bitwiseXOR(order).alias("root")), "moves", rows=2 * n)
        if labels is None:
            labels, nodes = moved, moved.count()
        else:
            step = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
            labels = materialise(labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels", rows=nodes)
        ends = [moved.select(F.col("node").alias(x), F.col("root").alias(f"to_{x}")) for x in "ab"]
        left = materialise(left.join(ends[0], "a").join(ends[1], "b").where("to_a <> to_b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges", rows=n)
        n = left.count()
    return labels
