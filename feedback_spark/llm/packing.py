"""Best-fit packing with several permitted sequence lengths.

Documents longer than the largest capacity are cut into pieces; the pieces
(ids and lengths only) are dealt evenly over shards of about ``SHARD_ITEMS``,
whatever their keys, and each task packs its shard best-fit decreasing.  Where
no open bin fits, a bin of the least-cost size is opened; several opening rules
are tried over the whole shard and the cheapest result is kept, after every bin
has been downsized to the smallest capacity that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, python_ready

#: Permitted sequence lengths; fixed cost of a sequence in tokens; pieces to a shard.
CAPACITIES, OVERHEAD, SHARD_ITEMS = (512, 1024, 2048, 4096, 8192), 16, 20_000
#: Pieces that a trial fill of a new bin looks for.
LOOKAHEAD = 6


def word_count(text: Column) -> Column:
    """Number of runs between white space (null: 0)."""
    return F.size(F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"\s+"), lambda w: w != "")).cast("long")


def downsized(used: list[int], capacities: list[int]) -> list[int]:
    return [capacities[bisect_left(capacities, u)] for u in used]


def best_fit(lengths: list[int], capacities: list[int], open_size) -> tuple[list[int], list[int]]:
    """Bin of each piece and the bins' contents; ``lengths`` descending; ``open_size(i)`` gives a new bin's capacity."""
    bins: list[int] = []
    used: list[int] = []
    free: dict[int, list[int]] = {}
    mask = 0  # bit s set: an open bin with s tokens left
    for i, n in enumerate(lengths):
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1  # the least space that holds the piece
            at = free[space].pop()
            if not free[space]:
                mask &= ~(1 << space)
        else:
            space, at = open_size(i), len(used)
            used.append(0)
        used[at] += n
        bins.append(at)
        if space > n:
            free.setdefault(space - n, []).append(at)
            mask |= 1 << (space - n)
    return bins, used


def least_cost_size(lengths: list[int], capacities: list[int], overhead: int):
    """Opening rule: the capacity whose trial fill with the pieces still to come costs least a token."""
    ascending = [-n for n in lengths]

    def size(i: int) -> int:
        best = (float("inf"), 0)
        for c in capacities:
            if c < lengths[i]:
                continue
            left, at = c - lengths[i], i + 1
            for _ in range(LOOKAHEAD):
                at = bisect_left(ascending, -left, at)
                if at >= len(lengths):
                    break
                left -= lengths[at]
                at += 1
            best = min(best, ((c + overhead) / (c - left), c))
        return best[1]

    return size


def pack(lengths: list[int], capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece (lengths in descending order), the bins' contents and downsized capacities: the cheapest rule's."""
    caps = sorted(capacities)
    rules = [least_cost_size(lengths, caps, overhead)]
    rules += [lambda i, c=c: c if c >= lengths[i] else caps[bisect_left(caps, lengths[i])] for c in caps]
    best = None
    for rule in rules:
        bins, used = best_fit(lengths, caps, rule)
        final = downsized(used, caps)
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = (cost, bins, used, final)
    return best[1:]


def pieces(docs: DataFrame, length: Column, largest: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, piece, start, n_tokens: each document whole, or cut at ``largest``; an empty one is one piece of 0."""
    rows = docs.select(*keep, F.coalesce(length, F.lit(0)).cast("long").alias("__n"))
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("__n") / largest) - 1).cast("long")))
    return rows.withColumn("piece", cut).select(*keep, "piece", (F.col("piece") * largest).alias("start"),
                                                F.least(F.lit(largest).cast("long"), F.col("__n") - F.col("piece") * largest).alias("n_tokens"))


def best_fit_pack(docs: DataFrame, length: Column, keep: tuple[str, ...] = ("doc_id",), capacities: tuple[int, ...] = CAPACITIES,
                  overhead: int = OVERHEAD, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: ``keep`` columns, piece, start, n_tokens, bin, offset (in the bin), capacity (of the bin).

    ``length`` is a document's number of tokens (null: 0).  A document longer
    than the largest capacity is cut; one without tokens keeps a row with a
    null bin.  Repeated rows are packed each, ties go by arrival; an empty
    table gives no rows; columns not kept play no part.
    """
    spark = docs.sparkSession
    python_ready(spark)
    items = materialise(pieces(docs, length, max(capacities), keep), "pieces")
    shards = max(1, -(-items.count() // shard_items))

    def packed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        held = list(batches)  # ids and lengths of about shard_items pieces
        if not held:
            return
        rows = pa.Table.from_batches(held)
        n = rows.column("n_tokens").to_numpy()
        order = np.argsort(-n, kind="stable")
        some = int((n > 0).sum())
        bins, _, final = pack(n[order[:some]].tolist(), capacities, overhead) if some else ([], [], [])
        at, cap, offset = (np.full(len(n), -1, np.int64) for _ in range(3))
        filled: dict[int, int] = {}
        for i, b in zip(order.tolist(), bins, strict=False):
            at[i], cap[i], offset[i] = (shard << 32) + b, final[b], filled.get(b, 0)
            filled[b] = filled.get(b, 0) + int(n[i])
        none = at < 0
        extra = [pa.array(x, pa.int64(), mask=none) for x in (at, offset, cap)]
        out = rows.append_column("bin", extra[0]).append_column("offset", extra[1]).append_column("capacity", extra[2])
        yield from out.to_batches()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields] + ["bin long, offset long, capacity long"])
    return items.repartition(shards).mapInArrow(packed, schema)
