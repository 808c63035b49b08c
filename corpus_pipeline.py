"""Corpus pipeline over ``documents``: toxicity, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; ``run`` writes each result as Parquet in the shared
checkpoint folder and reads it back for the next stage.

Rows and edge cases: documents scored toxic go; of each near-duplicate group
the one of the smallest doc_id stays; secrets are replaced by a mark in the text
(no row goes); mixing keeps every document at least once and repeats those of
scarce domains; packing returns a row for each piece of a document with its bin
(null for a text without words).  Null texts count as empty and null ids are
carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, table
from feedback_spark.llm.mixing import mix, resample
from feedback_spark.llm.packing import best_fit_pack, word_count
from feedback_spark.llm.queries import TOXIC_FROM, labelled_domains, toxic_model
from feedback_spark.llm.secret_scan import redact
from feedback_spark.llm.simhash import keep_one
from feedback_spark.llm.toxicity import without_toxic

#: Rates of the mixing stage: every document stays, none is repeated more often.
LEAST_RATE, MOST_RATE = 1.0, 3.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, toxic_model(spark, sf_dir), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, words=4, most=4)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resample(docs, mix(docs, labelled_domains(spark, sf_dir), lower=LEAST_RATE, upper=MOST_RATE))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_pack(docs, word_count(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", hide_secrets),
    ("mixing", mix_domains),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the fitted models and the packing; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
