"""What the two vector searches share: valid rows, query passes, merging of local results."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedback_spark.llm.common import materialise

#: Queries of one pass over the candidates (their vectors are broadcast: bounded).
QUERIES_A_PASS = 4096
#: Candidates of one task at least (fewer tasks, fewer local results).
ROWS_A_TASK = 250_000
#: Rows of one array block within a task.
BLOCK = 4096


def finite(v: Column) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(odd, F.lit(True))


def usable(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id (long) and vector (array<double>) of the rows that take part."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & finite(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))


def passes(queries: DataFrame) -> Iterator[list[tuple[int, list[float]]]]:
    """The queries in bounded passes by a hash of both: (vec_id, vector) lists, each distinct one once (an id may have several)."""
    one = materialise(queries.select("vec_id", "vector").distinct(), "queries")
    n = one.count()
    slabs = max(1, -(-n // QUERIES_A_PASS))
    for k in range(slabs if n else 0):
        part = one.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(slabs)) == k) if slabs > 1 else one
        rows = part.orderBy("vec_id", "vector").collect()  # about QUERIES_A_PASS rows
        if rows:
            yield [(r["vec_id"], r["vector"]) for r in rows]


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """At most as many tasks as the cores twice over, or as ``rows`` need."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)))


def ranked(found: DataFrame, k: int, score: Column, largest: bool) -> DataFrame:
    """query_id, rank, vec_id, score: the k best vec_ids of each query from local results, ties to the smaller vec_id."""
    best = found.groupBy("query_id", "vec_id").agg((F.max if largest else F.min)("score").alias("score"))  # repeated rows: one result
    order = W.partitionBy("query_id").orderBy(F.desc("score") if largest else F.asc("score"), "vec_id")
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


class Best:
    """The k best (score, id) of a query so far; larger scores first, ties to the smaller id, an id once."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        import numpy as np

        self.k, self.scores, self.ids = k, np.empty(0), np.empty(0, np.int64)

    def bound(self) -> float:
        """A candidate below this score cannot enter."""
        return float(self.scores[-1]) if len(self.ids) == self.k else -float("inf")

    def add(self, scores, ids) -> None:
        import numpy as np

        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((i, -s))
        s, i = s[order], i[order]
        _, first = np.unique(i, return_index=True)
        first.sort()
        first = first[:self.k]
        self.scores, self.ids = s[first], i[first]


def blocks(batches: Iterator, columns: tuple[str, str] = ("vec_id", "vector")) -> Iterator:
    """(ids, matrix) of at most ``BLOCK`` rows of equal dimension, from Arrow batches."""
    import numpy as np

    held: dict[int, list] = {}

    def joined(parts: list):
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    for b in batches:
        ids, lists = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)
        for d in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == d)
            part = flat[ends[at][:, None] + np.arange(d)]
            for s in range(0, len(at), BLOCK):
                held.setdefault(d, []).append((ids[at[s:s + BLOCK]], part[s:s + BLOCK]))
                if sum(len(p[0]) for p in held[d]) >= BLOCK:
                    yield joined(held.pop(d))
    for parts in held.values():
        yield joined(parts)
