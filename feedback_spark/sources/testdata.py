"""Driver tables and the ``reviews`` adapter.

``reviews`` turns the driver's ``documents`` table into unified review rows
(FIXTURES.md §7).  Every derived column is a pure function of the document
row, so the adapter is a narrow projection over the Parquet scan; the same
view is written in DuckDB SQL in :mod:`feedback_spark.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, index_col) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index_col + 1).cast("int"))


def products(spark: SparkSession) -> DataFrame:
    """A3: product dimension (product, product_type, description, use_llm)."""
    return spark.createDataFrame(
        FV.PRODUCTS, "product string, product_type string, description string, use_llm boolean"
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified review rows derived from ``documents`` (before cleaning)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    prod_idx = F.pmod(F.col("n_chars"), F.lit(len(FV.PRODUCTS)))
    phrase_idx = F.pmod(F.expr("n_chars div 4"), F.lit(len(FV.ADAPTER_PHRASES)))
    platform = _pick(FV.ADAPTER_PLATFORMS, F.pmod(F.col("doc_id"), F.lit(len(FV.ADAPTER_PLATFORMS))))
    return d.select(
        F.col("doc_id").alias("review_id"),
        _pick([p[0] for p in FV.PRODUCTS], prod_idx).alias("product"),
        _pick([p[1] for p in FV.PRODUCTS], prod_idx).alias("product_type"),
        platform.alias("platform"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(700)).cast("int")).alias("date"),
        F.concat(F.lit("user_"), F.pmod(F.col("doc_id"), F.lit(50)).cast("string")).alias("author"),
        F.when(F.pmod(F.col("doc_id"), F.lit(3)) == 0, F.lit(None).cast("double"))
        .otherwise((F.pmod(F.col("doc_id"), F.lit(5)) + 1).cast("double"))
        .alias("rating"),
        F.concat(F.col("text"), F.lit(" "), _pick(FV.ADAPTER_PHRASES, phrase_idx)).alias("review_text"),
        F.concat(F.lit("https://reviews.example/"), platform, F.lit("/"), F.col("doc_id").cast("string")).alias("source_url"),
    )
