"""Approximate nearest neighbours: lists of nearby vectors, probed with an adaptive dimension scan.

Index: k-means centroids of a bounded sample, for each dimension its own; every
row goes to the list of its dimension's nearest centroid.  A list's vectors, turned by one random rotation, are stored
in blocks with the dimensions side by side (column blocks), beside the original
vectors; large lists are dealt over several tasks.  The index is a Parquet
table in the shared checkpoint folder.

Search: a query probes the lists of its nearest centroids.  Within a list the
squared distances are added up one column block after the other; after each, a
hypothesis test compares the partial distance, scaled up to all dimensions,
with the k-th best so far, and gives up candidates that are larger beyond doubt
(``DOUBT``) and beyond the rounding of the stored blocks.  Survivors get their exact distance from the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, python_ready
from feedback_spark.llm.vectors import BLOCK, Best, blocks, few_tasks, passes, ranked, usable

#: Rows (on average) that the centroids are fitted on, k-means rounds, lists of a dimension at most, rows a list should have.
SAMPLE_ROWS, ROUNDS, MOST_LISTS, ROWS_A_LIST = 20_000, 8, 1024, 400
#: Share of the lists that a query probes, and at least how many.
PROBED, LEAST_PROBED = 0.75, 8
#: Dimensions of a column block; width of the hypothesis test (standard units of 1 / sqrt(dimensions)).
COLUMNS, DOUBT = 16, 2.1
#: Rows of one list that go to one task.
ROWS_A_DEAL = 20_000


def rotation(d: int, seed: int = 9):
    """A random orthogonal matrix."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def nearest(x, centroids):
    """Squared distances to the centroids, less the rows' own norms."""
    return (centroids * centroids).sum(1) - 2 * (x @ centroids.T)


def k_means(x, lists: int, seed: int = 9):
    import numpy as np

    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    c = distinct[rng.permutation(len(distinct))[:lists]]
    for _ in range(ROUNDS):
        at = nearest(x, c).argmin(1)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


class Index:
    """Blocks (list, n, ids, turned, original) as a table, and by dimension the number of its first list and the centroids."""

    def __init__(self, table: DataFrame, centroids: dict, rows: int):
        self.table, self.centroids, self.rows = table, centroids, rows


def build_index(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """Index of every usable row; None if there is none."""
    import numpy as np

    spark = table.sparkSession
    python_ready(spark)
    rows = usable(table, vec_id, vector).where(F.exists("vector", lambda x: x != 0))
    dims = {r["d"]: r["count"] for r in rows.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()}  # a row for each dimension
    if not dims:
        return None
    n = sum(dims.values())
    parts: dict[int, list] = {d: [] for d in dims}
    for r in rows.select("vector").where(F.rand(9) < min(1.0, sample_rows / n)).collect():
        parts[len(r["vector"])].append(r["vector"])
    centroids, first = {}, 0
    for d, part in parts.items():
        sample = np.array(part or [[0.0] * d], np.float64)  # a dimension without a row in the sample has one list
        scale = max(float(np.abs(sample).max()), 1e-300)  # centroids are directions of a common scale; distances below use the rows' own
        c = k_means(sample / scale, int(min(MOST_LISTS, max(1, dims[d] // ROWS_A_LIST)))) * scale
        centroids[d] = first, c
        first += len(c)
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        turns: dict = {}
        for ids, x in blocks(batches):
            d = x.shape[1]
            first, c = sent.value[d]
            if d not in turns:
                turns[d] = rotation(d)
            at = first + nearest(x, c).argmin(1)
            turned = (x @ turns[d]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ids, pa.int64()), pa.array([r.tobytes() for r in turned], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())], ["list", "vec_id", "turned", "original"])

    assigned = materialise(rows.mapInArrow(assign, "list int, vec_id long, turned binary, original binary"), "assigned")
    sizes = assigned.groupBy("list").count().collect()  # at most MOST_LISTS rows a dimension
    deals = {r["list"]: -(-r["count"] // ROWS_A_DEAL) for r in sizes if r["count"] > ROWS_A_DEAL}
    parts = F.lit(1)
    if deals:
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in deals.items() for x in kv]), F.col("list")), F.lit(1))
    dealt = assigned.withColumn("deal", F.pmod(F.xxhash64("vec_id", F.crc32("original")), parts)).repartition("list", "deal").sortWithinPartitions("list").select("list", "vec_id", "turned", "original")

    def block(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(at: int, held: list):
            ids = np.array([h[0] for h in held], np.int64)
            turned = np.stack([np.frombuffer(h[1], np.float32) for h in held])
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([turned.T.tobytes()], pa.binary()), pa.array([b"".join(h[2] for h in held)], pa.binary())], ["list", "n", "ids", "turned", "original"])

        at, held = None, []
        for b in batches:
            for where, *row in zip(*(b.column(c).to_pylist() for c in ("list", "vec_id", "turned", "original")), strict=True):
                if held and (where != at or len(held) >= BLOCK):
                    yield out(at, held)
                    held = []
                at = where
                held.append(row)
        if held:
            yield out(at, held)

    # dimensions side by side: all rows' first, then all rows' second, ...
    return Index(materialise(dealt.mapInArrow(block, "list int, n int, ids binary, turned binary, original binary"), "index"), centroids, n)


def norms(original):
    """Lengths of the rows."""
    import numpy as np

    return np.sqrt((original * original).sum(1))


def scan_list(ids, turned, original, sizes, q_id: int, q_turned, q, best: Best) -> None:
    """Adaptive dimension scan of one block (``sizes``: its rows' lengths); scores in ``best`` are negative squared distances."""
    import numpy as np

    d = len(q)
    live = np.flatnonzero(ids != q_id)
    least = best.bound()
    if np.isfinite(least):
        part = np.zeros(len(live))
        single = np.finfo(np.float32)  # ``turned`` was rounded to it: a distance is wrong by this much at most
        slack = single.eps * (sizes[live] + np.sqrt(q @ q)) + single.smallest_subnormal * np.sqrt(d)
        for a in range(0, d - COLUMNS, COLUMNS):
            gap = turned[a:a + COLUMNS, live] - q_turned[a:a + COLUMNS, None]
            part += (gap * gap).sum(0)
            seen = a + COLUMNS
            keep = np.sqrt(part) <= np.sqrt(-least * seen / d) * (1 + DOUBT / np.sqrt(seen)) + slack
            live, part, slack = live[keep], part[keep], slack[keep]
            if not len(live):
                return
    gap = original[live] - q
    best.add(-(gap * gap).sum(1), ids[live])


def search(index: Index, queries: DataFrame, k: int, probed: float = PROBED) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) from the index, for ``queries`` (vec_id, vector)."""
    import numpy as np

    spark = queries.sparkSession
    results = None
    for slab in passes(queries):
        by_size: dict[int, list] = {}
        for i, v in slab:
            by_size.setdefault(len(v), []).append((i, v))
        q_ids, qs, q_turned, lists = [], [], [], []
        for d, mine in by_size.items():
            if d not in index.centroids:
                continue
            first, c = index.centroids[d]
            q = np.array([v for _, v in mine], np.float64)
            n = min(len(c), max(LEAST_PROBED, int(np.ceil(probed * len(c)))))
            q_ids += [i for i, _ in mine]
            qs += list(q)
            q_turned += list(q @ rotation(d))
            lists += (first + np.argsort(nearest(q, c), axis=1)[:, :n]).tolist()
        sent = spark.sparkContext.broadcast((q_ids, qs, q_turned, lists))

        def probe(batches: Iterator, sent=sent) -> Iterator:
            import numpy as np
            import pyarrow as pa

            q_ids, q, q_turned, lists = sent.value
            by: dict[int, list[int]] = {}
            for j, row in enumerate(lists):
                for at in row:
                    by.setdefault(at, []).append(j)
            best: dict[int, Best] = {}
            for b in batches:
                for at, n, ids, turned, original in zip(*(b.column(c).to_pylist() for c in ("list", "n", "ids", "turned", "original")), strict=True):
                    if at not in by:
                        continue
                    ids = np.frombuffer(ids, np.int64)
                    turned = np.frombuffer(turned, np.float32).reshape(-1, n).astype(np.float64)
                    original = np.frombuffer(original, np.float64).reshape(n, -1)
                    sizes = norms(original)
                    for j in by[at]:
                        scan_list(ids, turned, original, sizes, q_ids[j], q_turned[j], q[j], best.setdefault(j, Best(k)))
            rows = [(q_ids[j], i, np.sqrt(-s)) for j, b in best.items() for s, i in zip(b.scores, b.ids.tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([float(r[2]) for r in rows], pa.float64())], ["query_id", "vec_id", "score"])

        # blocks are large rows: small batches
        part = few_tasks(index.table, index.rows).mapInArrow(probe, "query_id long, vec_id long, score double")
        results = part if results is None else results.unionByName(part)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return ranked(results, k, F.col("score"), largest=False)


def nearest_neighbours(table: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", probed: float = PROBED) -> DataFrame:
    """query_id, rank, vec_id, score: about the k nearest rows of every query by Euclidean distance, nearest first.

    Queries are the rows with ``is_query`` (over ``vec_id``), candidates all
    rows but those of the query's own id; ties go to the smaller vec_id.  Rows
    without an id and vectors that are null, empty, zero or hold null or
    non-finite components take no part; vectors of different dimension never
    meet.  Rows that share an id count once, by the least distance over
    all their vectors; fewer candidates than k in the
    probed lists give fewer rows unless all lists are probed; an empty table
    gives none.
    """
    spark = table.sparkSession
    index = build_index(table, vec_id, vector)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = usable(table, vec_id, vector).where(is_query & F.exists("vector", lambda x: x != 0))
    return search(index, queries, k, probed)
