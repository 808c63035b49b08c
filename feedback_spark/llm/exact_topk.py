"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... equal segments; each keeps its mean m and
standard deviation s.  For a segment of length n the squared distance of two
vectors is at least n * ((m - m')^2 + (s - s')^2); with |x|^2 and |q|^2 known
that is an upper bound n * (m m' + s s') on the inner product.  Each task keeps
the k best of every query, tests candidates against the k-th from the coarsest
bound to the finest, and computes exact products of the survivors only.

Queries are broadcast in bounded passes; candidates are never shuffled, only
each task's k best of a query are.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import python_ready
from feedback_spark.llm.vectors import Best, blocks, few_tasks, passes, ranked, usable

#: Coarsest to finest numbers of segments (those below a vector's dimension are used), candidates that set a first bound.
LEVELS, SEEDS = (4, 8, 16, 32), 64
#: Products beyond this are not exact in doubles; they are then computed with whole numbers and kept within a long.
EXACT = float(2 ** 53)


def statistics(x, segments: int):
    """Rows of weighted means and deviations: the dot product of two rows bounds the vectors' inner product."""
    import numpy as np

    cuts = [len(x[0]) * i // segments for i in range(segments + 1)]
    parts = [x[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    means = [p.mean(1) * np.sqrt(p.shape[1]) for p in parts]
    spread = [p.std(1) * np.sqrt(p.shape[1]) for p in parts]
    return np.stack(means + spread, 1)


def products(x, q):
    """Inner products of the rows with ``q``, exact: whole numbers within a long."""
    import numpy as np

    if len(x) and np.abs(x).max() * np.abs(q).max() * len(q) >= EXACT:
        whole = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
        return np.array([float(max(-2 ** 63, min(2 ** 63 - 1024, w))) for w in whole])
    return x @ q


def search_block(ids, x, queries: list, stats: dict, best: list[Best]) -> None:
    """Bring the block's candidates into ``best`` (one per query of this dimension)."""
    import numpy as np

    d = x.shape[1]
    levels = [s for s in LEVELS if s < d] or [1]
    mine = [statistics(x, s) for s in levels]
    norm = np.sqrt((x * x).sum(1))
    coarse = stats[levels[0]] @ mine[0].T
    for j, (q_id, q) in enumerate(queries):
        slack = 1e-9 * norm * np.sqrt(q @ q) + 1e-6  # rounding of the bounds
        bound = coarse[j] + slack
        live = np.flatnonzero(ids != q_id)
        if best[j].bound() == -np.inf and len(live) > SEEDS:
            first = live[np.argpartition(-bound[live], SEEDS)[:SEEDS]]
            best[j].add(products(x[first], q), ids[first])
        least = best[j].bound()
        live = live[bound[live] >= least]
        for s, level in zip(levels[1:], mine[1:], strict=True):
            if len(live) <= SEEDS:
                break
            live = live[level[live] @ stats[s][j] + slack[live] >= least]
        if len(live):
            score = products(x[live], q)
            keep = score >= least
            best[j].add(score[keep], ids[live[keep]])


def exact_topk(table: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of every query, ties to the smaller vec_id.

    Components x count as floor(scale * x).  Queries are the rows with
    ``is_query`` (over ``vec_id``), candidates all rows but those of the
    query's own id.  Rows without an id, and vectors that are null, empty or
    hold null or non-finite components, take no part; vectors of different
    dimension never meet.  Rows that share an id count once, by the best score
    over all their vectors, as queries and as candidates; scores beyond a long are kept at its ends.
    Fewer candidates than k give fewer rows, an empty table none.
    """
    spark = table.sparkSession
    python_ready(spark)
    rows = usable(table, vec_id, vector)
    n = table.count()
    results = None
    for slab in passes(rows.where(is_query)):
        sent = spark.sparkContext.broadcast(slab)

        def search(batches: Iterator, sent=sent) -> Iterator:
            import numpy as np
            import pyarrow as pa

            queries: dict[int, list] = {}
            for q_id, v in sent.value:
                queries.setdefault(len(v), []).append((q_id, np.floor(scale * np.array(v, np.float64))))
            stats = {d: {s: statistics(np.stack([v for _, v in q]), s) for s in ([s for s in LEVELS if s < d] or [1])} for d, q in queries.items()}
            best = {d: [Best(k) for _ in q] for d, q in queries.items()}
            for ids, x in blocks(batches):
                d = x.shape[1]
                if d in queries:
                    search_block(ids, np.floor(scale * x), queries[d], stats[d], best[d])
            for d, q in queries.items():
                rows = [(q_id, i, s) for (q_id, _), b in zip(q, best[d], strict=True) for s, i in zip(b.scores.tolist(), b.ids.tolist(), strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([int(r[2]) for r in rows], pa.int64())], ["query_id", "vec_id", "score"])

        part = few_tasks(rows, n).mapInArrow(search, "query_id long, vec_id long, score long")
        results = part if results is None else results.unionByName(part)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return ranked(results, k, F.col("score"), largest=True)
