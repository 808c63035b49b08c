"""Registered queries M1-M3: streaming runs over landed review files.

Each query lands the reviews adapter as Parquet files in a fresh folder under
the checkpoint folder in two steps, runs the streaming job to completion with an
``availableNow`` trigger after each, so that the second run meets the state, the
sink and the done table of the first, and returns a batch read of what the sink
holds.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from feedback_spark.operators.sentiment import score_lexicon_lane
from feedback_spark.operators.themes import tag_themes
from feedback_spark.plans.sql_base import base_ctes, scoring_ctes
from feedback_spark.sources.testdata import reviews
from feedback_spark.streaming import stream as S
from feedback_spark import fixed_values as FV


#: The dates of the adapter lie within 700 days and come in any order: nothing is too late.
LATE = "2000 days"


def _two_runs(spark, rows, run, repeat=True):
    """Land the first half of the documents, run, land the rest (``repeat``: and some of the first again), run."""
    root = S.work_dir(spark, "stream")
    landing = os.path.join(root, "landing")
    half = F.pmod(F.floor(F.col("review_id") / 7), F.lit(2)) == 0
    again = (F.pmod("review_id", F.lit(5)) == 0) if repeat else F.lit(False)
    for name, part in (("part1", half), ("part2", ~half | again)):
        S.land(rows.filter(part), os.path.join(landing, name))
        run(root, os.path.join(landing, "*"))
    return root


def _undated(spark, sf):
    """The reviews, every sixth without a date."""
    return reviews(spark, sf).withColumn("date", F.when(F.pmod("review_id", F.lit(6)) != 5, F.col("date")))


def _m1(spark, sf):
    root = _two_runs(spark, _undated(spark, sf), lambda root, landing: S.stream_ingest(
        spark, landing, os.path.join(root, "clean"), os.path.join(root, "ckpt"), watermark=LATE))
    out = S.read_ingested(spark, os.path.join(root, "clean"))
    # the group state keeps a known survivor; the built-in dedup keeps the row that came first, compared by its landing
    landed = F.when(F.pmod(F.floor(F.col("review_id") / 7), F.lit(2)) == 0, 1).otherwise(2)
    return out.select("product", "review_text", F.col("date").isNotNull().alias("dated"), landed.alias("landed"),
                      F.when(F.col("date").isNull(), F.col("review_id")).alias("undated_id"))


def _m2_stream(spark, landing):
    s = S.read_landing(spark, landing)
    return (s.withColumn("review_text", S.clean_text("review_text")).filter(F.length("review_text") > FV.MIN_TEXT_LEN_INGEST)
            .filter(F.col("date").isNotNull()).withColumn("event_ts", F.col("date").cast("timestamp")))


def _m2_run(spark, sf, prepare, **kw):
    return _two_runs(spark, reviews(spark, sf), lambda root, landing: S.stream_counts(
        spark, prepare(_m2_stream(spark, landing)), os.path.join(root, "counts"), os.path.join(root, "ckpt"), watermark=LATE, **kw), repeat=False)


def _m2(spark, sf):
    root = _m2_run(spark, sf, score_lexicon_lane)
    return S.read_latest(spark, os.path.join(root, "counts"), ["product", "window_start", "sentiment"])


def _m2_themes(spark, sf):
    root = _m2_run(spark, sf, tag_themes, counts=S.theme_window_counts)
    return S.read_latest(spark, os.path.join(root, "counts"), ["product", "window_start", "theme"])


def _m3(spark, sf):
    def run(root, landing):
        s = S.read_landing(spark, landing).withColumn("review_text", S.clean_text("review_text")).filter(
            F.length("review_text") > FV.MIN_TEXT_LEN_INGEST)
        S.stream_enrich(spark, s, os.path.join(root, "enriched"), os.path.join(root, "ckpt"))

    root = _two_runs(spark, reviews(spark, sf), run)
    return spark.read.parquet(os.path.join(root, "enriched")).select("product", "review_text", "enrich_status", F.col("batch_id").cast("long").alias("batch_id"))


#: The rows in the order of their landing: (landing, row) with the repeated ones of the second.
LANDED_SQL = """landed AS (
  SELECT *, 1 AS landing FROM cleaned WHERE (review_id // 7) % 2 = 0
  UNION ALL SELECT *, 2 AS landing FROM cleaned WHERE (review_id // 7) % 2 = 1 OR review_id % 5 = 0)"""


def _m1_sql() -> str:
    return f"""WITH {base_ctes()},
{LANDED_SQL},
firsts AS (
  SELECT product, review_text, review_id % 6 <> 5 AS dated, min(landing) AS landing, arg_min(review_id, landing * 1000000000 + review_id) AS id
  FROM landed GROUP BY ALL)
SELECT product, review_text, dated, CAST(landing AS INTEGER) AS landed, CASE WHEN NOT dated THEN id END AS undated_id FROM firsts"""


def _m3_sql() -> str:
    return f"""WITH {base_ctes()},
{LANDED_SQL}
SELECT product, review_text, 'queued' AS enrich_status, CAST(min(landing) - 1 AS BIGINT) AS batch_id FROM landed GROUP BY product, review_text"""


def _m2_sql(value: str = "sentiment", source: str = "sc2") -> str:
    import re

    # same prefix as the batch plans, but scoring the cleaned rows before dedup;
    # the second scoring chain gets its own CTE names
    second = scoring_ctes("cl2", "sc2")
    for name in ["lex", "toks", "tk", "tv2", "tv", "tsum", "pol3", "pol2", "pol", "lane"]:
        second = re.sub(rf"\b{name}\b", f"m2_{name}", second)
    return f"""WITH {base_ctes()},
cl2 AS (SELECT * FROM cleaned),
{second}
SELECT product, CAST(time_bucket(INTERVAL 30 DAY, CAST(date AS TIMESTAMP), TIMESTAMP '1970-01-01') AS DATE) AS window_start,
       {value}, count(*) AS n
FROM {source} GROUP BY ALL"""


QUERIES = {
    "m1_stream_ingest": (_m1, _m1_sql()),
    "m2_stream_counts": (_m2, _m2_sql()),
    "m2_theme_counts": (_m2_themes, _m2_sql("theme", "(SELECT product, date, unnest(themes) AS theme FROM sc2)")),
    "m3_stream_enrich": (_m3, _m3_sql()),
}
