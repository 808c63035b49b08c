"""C: union, cleaning, dedup, numbering, sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.text import clean_date, clean_rating, clean_text

#: Most groups whose first numbers are broadcast.
MOST_SENT = 100_000
REVIEW_COLUMNS = ["platform", "date", "author", "rating", "review_text", "source_url"]


def unify(dfs: list[DataFrame]) -> DataFrame:
    """Union-all by name; missing columns become typed nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def ingest(sources: list[DataFrame], min_len: int = FV.MIN_TEXT_LEN_INGEST) -> DataFrame:
    """Collection run: C1 union in collector order, C2/C3/C7/C4 cleaning, C5 dedup
    across sources (the earliest collector keeps a text shared by several)."""
    ranked = [df.select(*REVIEW_COLUMNS).withColumn("source_rank", F.lit(i)) for i, df in enumerate(sources)]
    r = clean_reviews(unify(ranked), min_len)
    # copies inside one source are ordered by their content, so the survivor is deterministic
    order = ["source_rank", "date", "author", "rating", "source_url"]
    return dedup_first(r, ["review_text"], order).drop("source_rank")


def clean_reviews(r: DataFrame, min_len: int = FV.MIN_TEXT_LEN_INGEST) -> DataFrame:
    """C2 + C3 + C7 + C4: trim text, coerce date and rating, length filter."""
    return (
        r.withColumn("review_text", clean_text("review_text"))
        .withColumn("date", clean_date("date"))
        .withColumn("rating", clean_rating("rating"))
        .filter(F.length("review_text") > min_len)
    )


def min_length(r: DataFrame, n: int = FV.MIN_TEXT_LEN, trim: bool = True) -> DataFrame:
    """C4: keep texts longer than ``n`` code points (optionally trimmed first)."""
    t = clean_text("review_text") if trim else F.col("review_text")
    return r.withColumn("review_text", t).filter(F.length("review_text") > n)


def dedup_first(r: DataFrame, key: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Exact dedup on ``key``; the first row in ``order`` survives.

    One shuffle on the key, with map-side partial aggregation: a group of
    copies, however large, is reduced to one row per map task before the
    exchange, so a hot text never lands whole on one reducer.
    """
    key = key or ["product", "review_text"]
    order = order or ["review_id"]
    rest = [c for c in r.columns if c not in key]
    ord_struct = F.struct(*[F.col(c) for c in order])
    agg = r.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ord_struct).alias("_w"))
    return agg.select(*key, *[F.col("_w")[c].alias(c) for c in rest]).select(*r.columns)


def platform_counts(r: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per platform, most first."""
    by = by or ["product"]
    return r.groupBy(*by, "platform").agg(F.count("*").alias("n")).orderBy(*by, F.desc("n"), "platform")


def with_seq(r: DataFrame, order: list[str] | None = None, group: list[str] | None = None,
             partitions: int | None = None) -> DataFrame:
    """Dense 1-based ``review_seq`` in ``order`` without a global window.

    Range-partition + sort within partitions, cut lineage (so both passes see
    identical partitions), count rows per partition (one tiny aggregate),
    turn counts into offsets on that tiny frame, broadcast them back.  With
    ``group`` (a prefix of ``order``) numbering restarts at 1 per group: the
    group's first global number comes from a second tiny aggregate.
    """
    from feedback_spark.session import cut_lineage

    order = order or ["review_id"]
    # the partition count follows spark.sql.shuffle.partitions unless given
    ranged = (r.repartitionByRange(partitions, *order) if partitions else r.repartitionByRange(*order)).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_cnt"), F.min("_mid").alias("_first"))
    # one row per partition: bounded, safe to broadcast; the window runs on that tiny frame
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    out = (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn("review_seq", F.col("_off") + (F.col("_mid") - F.col("_first")) + 1)
        .drop("_pid", "_mid", "_cnt", "_first", "_off")
    )
    if group:
        # one row per group; few are sent to the rows, which would otherwise go to one task per group
        starts = cut_lineage(out.groupBy(*group).agg(F.min("review_seq").alias("_g0")))
        out = out.join(F.broadcast(starts) if starts.count() <= MOST_SENT else starts, group).withColumn("review_seq", F.col("review_seq") - F.col("_g0") + 1).drop("_g0")
    return out


def sample_n(r: DataFrame, n: int, seed: int = 42, key: str = "review_id") -> DataFrame:
    """Reproducible sample of exactly min(n, count) rows.

    Rows are ranked by md5("<seed>:<key>") (the same digest in any engine) and
    the first n kept; ``orderBy(...).limit(n)`` plans as a per-partition
    top-n with a final merge, never a full sort.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return r.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def carry_forward(prev: DataFrame, new: DataFrame, key: str = "platform") -> DataFrame:
    """Keep earlier rows of any source that has no rows in this run."""
    present = new.select(key).distinct()
    return prev.join(present, key, "left_anti").unionByName(new, allowMissingColumns=True)
