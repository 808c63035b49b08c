"""Columns of the caller that are named like an operator's helpers come through every filtering stage unchanged."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from feedback_spark.llm.common import all_columns, free_prefix
from feedback_spark.llm.secret_scan import scan, with_spans

SF = "/root/testdata/sf0.001"
NAMES = ["__score", "__id", "__hash", "__times", "__text_hash", "__rate", "__assign", "__random", "__base", "__spans", "___times",
         "spans", "rate", "root", "component_id", "text_hash", "copies", "n_tokens", "a.b", "back`tick"]


@pytest.fixture(scope="module")
def docs(spark):
    first = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120)
    extra = [(i, f"password={'k3y' * 4}{i} and more words here {i % 2}") for i in range(-6, 0)]
    repeated = spark.createDataFrame([*extra, *extra], "doc_id long, text string")
    return first.unionByName(repeated, allowMissingColumns=True).withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})


@pytest.mark.parametrize("name,stage", P.STAGES[:4])
def test_clashing_names_come_through(spark, docs, name, stage):
    plain = docs.drop(*[n for n in NAMES if "`" not in n and "." not in n]).select("doc_id", *[c for c in ("text", "lang", "source", "n_chars") if c in docs.columns])
    want = sorted((r["doc_id"], r["text"] or "") for r in stage(spark, plain, SF).collect())
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in rows) == want and rows
    assert all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in NAMES)


def test_spans_beside_columns_of_the_same_names(spark, docs):
    want = {r["doc_id"]: r["s"] for r in scan(docs.select("doc_id", "text"), out="s").collect()}
    got = scan(docs, keep=("doc_id", "spans", "__spans"), out="found").collect()
    assert all(r["found"] == want[r["doc_id"]] and r["spans"] == f"spans {r['doc_id']}" and r["__spans"] == f"__spans {r['doc_id']}" for r in got)
    replaced = with_spans(docs, {}, out="spans")
    assert sorted(replaced.columns) == sorted(docs.columns) and isinstance(replaced.first()["spans"], list)


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`__a` int, `___` int, `x.y` int")
    assert free_prefix(df) == "____" and df.select(*all_columns(df)).columns == df.columns
