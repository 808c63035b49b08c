"""Regex dialect: the portable form must agree in Python re, Spark and DuckDB."""

import re

import duckdb
import pytest

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import escape_literal, portable

CASES = [
    (r"\b(deliver)\b", "fast delivery", False),        # stems do not match longer words
    (r"\b(deliver)\b", "they deliver fast", True),
    (r"\b(late)\b", "the delivery was late", True),
    (r"\b(caf)\b", "un café noir", False),              # accent next to the boundary
    (r"\b(on.?time)\b", "arrived on-time today", True),
    (r"\b(on.?time)\b", "arrived on\ntime", False),     # '.' does not cross a newline
    (r"\bwise\b", "otherwise fine", False),
    (r"\bwise\b", "sent via wise.", True),
    (r"please\s+add\b", "please  add dark mode", True),
    (r"please\s+add\b", "please address this", False),
    (r"using\s+\w+\s+i", "using édgewonk i", True),     # \w is Unicode
]


@pytest.mark.parametrize("pattern,text,expected", CASES)
def test_python_semantics(pattern, text, expected):
    assert bool(re.search(pattern, text, re.IGNORECASE)) is expected


@pytest.mark.parametrize("pattern,text,expected", CASES)
def test_duckdb_agrees(pattern, text, expected):
    got = duckdb.execute("SELECT regexp_matches(?, ?)", [text.lower(), portable(pattern)]).fetchone()[0]
    assert got is expected


def test_spark_agrees(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(CASES)], "i int, t string")
    exprs = [F.when(F.col("i") == i, F.lower("t").rlike(portable(p))) for i, (p, _, _) in enumerate(CASES)]
    got = {r.i: r.m for r in df.select("i", F.coalesce(*exprs).alias("m")).collect()}
    assert [got[i] for i in range(len(CASES))] == [e for _, _, e in CASES]


def test_all_fixed_patterns_compile_in_both_engines(spark):
    import duckdb as d
    from pyspark.sql import functions as F

    pats = [p for lst in FV.THEME_PATTERNS.values() for _, p in lst]
    pats += [p for lst in FV.COMPETITOR_PATTERNS.values() for _, p in lst]
    pats += [FV.SUCCESS_STORY_PATTERN, FV.PRODUCT_COMPLAINT_PATTERN, FV.FEATURE_REQUEST_PATTERN,
             FV.REQUEST_SUPPRESS_PATTERN, FV.CHURN_PATTERN]
    for p in pats:
        d.execute("SELECT regexp_matches('x', ?)", [portable(p)]).fetchone()
    spark.range(1).select(*[F.lit("x").rlike(portable(p)) for p in pats]).collect()


def test_escape_literal():
    assert re.search(escape_literal("a.b(c)"), "xa.b(c)y")
    assert not re.search(escape_literal("a.b"), "axb")
