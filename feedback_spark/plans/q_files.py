"""Registered queries A1, A4-A8: file sinks and sources, written to and read back
from a fresh folder under the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import sql_str
from feedback_spark.plans import q_enrich as QE
from feedback_spark.plans.sql_base import with_base
from feedback_spark.sources import files as A
from feedback_spark.sources.testdata import products, reviews
from feedback_spark.streaming.stream import work_dir
from feedback_spark.operators import enrich as K

COLS = ["platform", "date", "author", "rating", "review_text", "source_url"]


def _a1(spark, sf):
    root = work_dir(spark, "csv")
    out = os.path.join(root, "reviews_csv")
    A.export_csv(reviews(spark, sf).select(*COLS), out)          # A6: texts hold newlines, quotes, commas
    back = A.read_reviews(spark, out)                             # A1: multi-line aware, fixed schema
    return back.select("platform", F.col("date").cast("string").alias("date"), "author", "rating", "review_text", "source_url")


def _a7(spark, sf):
    root = work_dir(spark, "layers")
    r = reviews(spark, sf).select("product", *COLS)
    A.write_layer(r, os.path.join(root, "raw"), partition_by="product", fmt="csv")   # A4 (csv with header)
    cat = A.catalogue(spark, os.path.join(root, "raw"))
    return (cat.withColumn("product", F.regexp_extract("folder", r"product=([^/]+)$", 1))
            .groupBy("product").agg(F.sum("records").alias("records")))


def _a5(spark, sf):
    root = work_dir(spark, "responses")
    resp = QE.responses(spark, sf).withColumn("name", F.regexp_extract("file", r"([^/]+)$", 1)) \
        .withColumn("folder", F.regexp_extract("file", r"^([^/]+)/", 1))
    A.land_responses(resp, os.path.join(root, "files"))
    raw = A.read_responses(spark, os.path.join(root, "files"), below="*.{json,txt}")
    # file identity = "<folder>/<name>"; small files make many tasks, of which each would start Python to parse a few
    raw = raw.withColumn("file", A.landed_name()).repartition("file")
    p = K.parse_responses(raw.select("file", "body"), QE.BATCH)
    return p.groupBy("file", "method").agg(F.count("*").alias("objects"))


def _a8(spark, sf):
    root = work_dir(spark, "prompts")
    prompts = K.batch_prompts(QE.enrich_input(spark, sf), products(spark), QE.BATCH)
    A.write_prompts(prompts, os.path.join(root, "prompts"))
    return spark.read.parquet(os.path.join(root, "prompts")).select("product", "batch_no", "prompt")


def _a2(spark, sf):
    """Tiers enriched -> clean -> raw, of which only the last two exist."""
    root = work_dir(spark, "tiers")
    r = reviews(spark, sf).select(*COLS)
    A.write_layer(r, os.path.join(root, "raw"), partition_by=None, fmt="csv")
    A.write_layer(r.filter(F.col("rating").isNotNull()), os.path.join(root, "clean"), partition_by=None, fmt="csv")
    found = A.resolve_tier(spark, [os.path.join(root, t) for t in ("enriched", "clean", "raw")])
    return found.groupBy("platform").agg(F.count("*").alias("n"), F.sum(F.length("review_text")).alias("chars"))


def _a3(spark, sf):
    return (reviews(spark, sf).groupBy("product").agg(F.count("*").alias("reviews"))
            .join(products(spark), "product").select("product", "product_type", "description", "use_llm", "reviews"))


QUERIES = {
    "a2_tiered_source": (_a2, with_base("SELECT platform, count(*) AS n, sum(length(review_text)) AS chars FROM reviews WHERE rating IS NOT NULL GROUP BY platform")),
    "a3_products": (_a3, with_base("SELECT r.product, p.product_type, p.description, p.use_llm, r.reviews FROM (SELECT product, count(*) AS reviews FROM reviews GROUP BY product) r JOIN (VALUES "
                                   + ", ".join(f"({sql_str(p)}, {sql_str(t)}, {sql_str(d)}, {u})" for p, t, d, u in FV.PRODUCTS)
                                   + ") p(product, product_type, description, use_llm) ON p.product = r.product")),
    "a1_csv_roundtrip": (_a1, with_base("SELECT platform, CAST(date AS VARCHAR) AS date, author, rating, review_text, source_url FROM reviews")),
    "a4_a7_layer_catalogue": (_a7, with_base("SELECT product, count(*) AS records FROM reviews GROUP BY product")),
    "a5_read_responses": (_a5, QE._with("\nSELECT file, method, count(*) AS objects FROM parsed GROUP BY file, method")),
    "a8_write_prompts": (_a8, f"SELECT product, batch_no, prompt FROM ({QE._prompts_sql(QE.BATCH, True)})"),
}
