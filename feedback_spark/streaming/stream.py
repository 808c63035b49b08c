"""M1-M3: Structured Streaming ingest, windowed counts and resume.

* ``stream_ingest`` (M1): landed review files -> C2-C4 -> late-safe dedup
  with ``withWatermark`` + ``dropDuplicatesWithinWatermark`` -> Parquet sink.
  Rows without a date have no event time: their texts are remembered by a
  group state with a processing-time limit (``first_undated``).
* ``stream_counts`` (M2): scored stream -> tumbling-window sentiment counts
  in update mode; ``foreachBatch`` appends each batch's changed rows with the
  batch id (an append-only changelog), and ``read_latest`` takes the newest
  row per key, so the sink never rewrites files and a restart replays safely.
* ``stream_enrich`` (M3): ``foreachBatch`` queues the reviews of a
  micro-batch that are not done yet (K18).  Which are done is looked up in
  ``done.DoneTable``, of which a batch reads only the parts that it needs.

All state lives under the checkpoint folder named by ``spark.checkpoint.dir``
(shared storage on a cluster), so a lost executor or a restarted driver
resumes from the last committed batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.text import clean_date, clean_rating, clean_text
from feedback_spark.operators.enrich import text_key
from feedback_spark.session import checkpoint_dir, ship_package
from feedback_spark.streaming.done import DoneTable

REVIEW_STREAM_SCHEMA = ("review_id long, product string, product_type string, platform string, date date, author string, "
                        "rating double, review_text string, source_url string")


#: How far behind the newest event a row may come.
WATERMARK = "90 days"
#: How long the text of an undated row is remembered after its last copy.
UNDATED_TTL_MS = 90 * 24 * 3600 * 1000


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    root = checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def read_landing(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """Landed files as a stream; ``files_per_trigger`` (None: no limit) paces the micro-batches."""
    reader = spark.readStream.schema(REVIEW_STREAM_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing)


def _cleaned(s: DataFrame) -> DataFrame:
    return (s.withColumn("review_text", clean_text("review_text")).withColumn("date", clean_date("date"))
            .withColumn("rating", clean_rating("rating")).filter(F.length("review_text") > FV.MIN_TEXT_LEN_INGEST))


def undated(s: DataFrame) -> DataFrame:
    """M1, cleaned rows without a date."""
    return _cleaned(s).filter(F.col("date").isNull())


def first_undated(s: DataFrame, ttl_ms: int = UNDATED_TTL_MS) -> DataFrame:
    """M1 for rows without a date: the first row of each (product, text); of a micro-batch's copies that of smallest id.

    The state of a text is one flag under its digest.  It has no event time to
    expire by, so it goes when no copy has come for ``ttl_ms`` of processing time.
    """
    x = undated(s).withColumn("text_key", F.md5("review_text"))
    columns = [c for c in x.columns if c != "text_key"]

    def first(_key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        known, best = state.exists, None
        for f in frames:  # the copies come in pieces: a hot text is never held whole
            if not known and len(f):
                at = f["review_id"].fillna(float("inf")).argmin()
                if best is None or _before(f["review_id"].iloc[at], best["review_id"].iloc[0]):
                    best = f.iloc[at:at + 1]
        state.update((True,))
        state.setTimeoutDuration(ttl_ms)
        if best is not None:
            yield best[columns]

    return x.groupBy("product", "text_key").applyInPandasWithState(first, x.select(*columns).schema, "seen boolean", "append", "ProcessingTimeTimeout")


def _before(a, b) -> bool:
    """Whether id ``a`` comes before ``b`` (a missing id comes last)."""
    return a == a and (b != b or a < b)


def clean_stream(s: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """M1 transformation: trim, coerce, length filter, late-safe dedup on (product, text).

    The dedup state is keyed by a 128-bit digest of the text (``text_key``),
    so the state store holds 16-byte keys instead of whole texts.  The
    watermark bounds how long keys are kept: rows that come later than it are
    dropped.  Rows without a date go by ``undated``.
    """
    x = (_cleaned(s).filter(F.col("date").isNotNull()).withColumn("event_ts", F.col("date").cast("timestamp"))
         .withColumn("text_key", F.unhex(F.md5("review_text"))))
    return (x.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["product", "text_key"])
            .drop("text_key"))


#: Batches without rows let time pass for a state's limits; a run to completion would never end with them.
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _run(spark: SparkSession, writer, ckpt: str) -> None:
    before = spark.conf.get(IDLE_BATCHES)
    spark.conf.set(IDLE_BATCHES, "false")  # read when the query starts
    try:
        query = writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    finally:
        spark.conf.set(IDLE_BATCHES, before)
    query.awaitTermination()


def stream_ingest(spark: SparkSession, landing: str, out: str, ckpt: str, watermark: str = WATERMARK, ttl_ms: int = UNDATED_TTL_MS,
                  files_per_trigger: int | None = None) -> None:
    """Run M1 to completion over what has landed (``availableNow``); dated rows go to ``out``/dated, the others to ``out``/undated."""
    ship_package(spark)
    for name, rows in (("dated", lambda s: clean_stream(s, watermark)), ("undated", lambda s: first_undated(s, ttl_ms))):
        landed = rows(read_landing(spark, landing, files_per_trigger))
        _run(spark, landed.writeStream.format("parquet").option("path", f"{out}/{name}").outputMode("append"), f"{ckpt}/{name}")


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """All rows that M1 has written to ``out``."""
    dated, undated_ = (spark.read.parquet(f"{out}/{name}") for name in ("dated", "undated"))
    return dated.drop("event_ts").unionByName(undated_)


def window_counts(s: DataFrame, width: str = "30 days", watermark: str = WATERMARK) -> DataFrame:
    """M2 transformation: (product, window, sentiment) counts."""
    return (s.withWatermark("event_ts", watermark)
            .groupBy("product", F.window("event_ts", width).alias("w"), "sentiment").agg(F.count("*").alias("n"))
            .select("product", F.col("w.start").cast("date").alias("window_start"), "sentiment", "n"))


def theme_window_counts(s: DataFrame, width: str = "30 days", watermark: str = WATERMARK) -> DataFrame:
    """M2 transformation: (product, window, theme) counts of a stream with ``themes``.

    The exploded array is an expression, not the bare column: for a column the
    optimizer adds a "has elements" filter and moves it down to the scan, where
    the whole tagging, written out once per use, would run a second time.
    """
    themes = F.transform("themes", lambda t: t)
    return (s.withWatermark("event_ts", watermark).select("product", "event_ts", F.explode(themes).alias("theme"))
            .groupBy("product", F.window("event_ts", width).alias("w"), "theme").agg(F.count("*").alias("n"))
            .select("product", F.col("w.start").cast("date").alias("window_start"), "theme", "n"))


def append_counts(counts: DataFrame, out: str, ckpt: str) -> None:
    """M2 in append mode: a window is written once, when the watermark has passed its end."""
    (counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append")
     .trigger(availableNow=True).start().awaitTermination())


def stream_counts(spark: SparkSession, scored_stream: DataFrame, out: str, ckpt: str, width: str = "30 days",
                  counts=window_counts, watermark: str = WATERMARK) -> None:
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = (counts(scored_stream, width, watermark).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key from an append-only changelog (partial-aggregated max_by)."""
    x = spark.read.parquet(path)
    vals = [c for c in x.columns if c not in keys and c != "batch_id"]
    agg = x.groupBy(*keys).agg(F.max_by(F.struct(*vals), "batch_id").alias("v"))
    return agg.select(*keys, *[F.col(f"v.{c}").alias(c) for c in vals])


def stream_enrich(spark: SparkSession, stream: DataFrame, done_path: str, ckpt: str, index: str | None = None) -> None:
    """M3: queue only reviews whose (product, text) has not been queued yet.

    The queue is ``done_path`` (a folder per batch), the table of what is done
    ``index`` (``done_path``-keys if none is given).  A batch that is run
    again after a failure replaces its own rows: what it added itself does not
    count as done.
    """
    done = DoneTable(spark, index or f"{done_path.rstrip('/')}-keys")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # one row per text inside the micro-batch, smallest id first (partial-aggregated)
        own = batch.groupBy("product", "review_text").agg(F.min("review_id").alias("review_id"))
        path = f"{done_path.rstrip('/')}/batch_id={batch_id}"
        done.unseen(own, but_batch=batch_id).withColumn("enrich_status", F.lit("queued")).write.mode("overwrite").parquet(path)
        done.add(spark.read.parquet(path), batch_id)

    _run(spark, stream.writeStream.foreachBatch(sink), ckpt)


def land(df: DataFrame, landing: str, files: int | None = None) -> None:
    """Write rows as several landed files (arrival order = review order); without ``files`` their number grows with the rows."""
    ranged = df.repartitionByRange(files, "review_id") if files else df.repartitionByRange("review_id")
    ranged.sortWithinPartitions("review_id").write.mode("overwrite").parquet(landing)
