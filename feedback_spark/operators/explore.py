"""J: filtering, search, listing, top-k quotes, column profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import escape_literal
from feedback_spark.functions.text import snippet, stars
from feedback_spark.functions.topk import top_k
from feedback_spark.operators.metrics import with_family

P = "product"


def facet_filter(r: DataFrame, platforms: list | None = None, sentiments: list | None = None) -> DataFrame:
    """Membership filters; a ``None`` in the list keeps null rows."""
    def keep(col: str, values: list | None):
        if values is None:
            return F.lit(True)
        vals = [v for v in values if v is not None]
        cond = F.col(col).isin(vals) if vals else F.lit(False)
        return cond | F.col(col).isNull() if len(vals) < len(values) else cond
    return r.filter(keep("platform", platforms) & keep("sentiment", sentiments))


def _ci(pattern: str, literal: bool) -> str:
    # java.util.regex: i, u, U = case-insensitive, by Unicode, with Unicode \\b \\w \\s \\d as in Python's re
    return "(?iuU)" + (escape_literal(pattern) if literal else pattern)


def search_text(r: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """Case-insensitive regex (or literal) search in the review text."""
    return r.filter(F.col("review_text").rlike(_ci(pattern, literal)))


def search_any(df: DataFrame, pattern: str, cols: list[str] | None = None, match_null: bool = False) -> DataFrame:
    """Any column, cast to text, matches; nulls match only with ``match_null``."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    rx = _ci(pattern, False)
    preds = [
        (F.coalesce(F.col(c).cast("string"), F.lit("nan")) if match_null else F.col(c).cast("string")).rlike(rx)
        for c in cols
    ]
    return df.filter(reduce(lambda a, b: a | b, preds))


def review_listing(r: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Available columns, newest first (nulls last), then review order."""
    cols = [c for c in (cols or ["date", "platform", "rating", "sentiment", "review_text"]) if c in r.columns]
    return r.select(P, "review_id", *cols).orderBy(P, F.desc_nulls_last("date"), "review_id")


def head(df: DataFrame, n: int, group: list[str] | None = None, order: list | None = None) -> DataFrame:
    """First ``n`` rows per group in a total order (each task keeps its n first before the shuffle)."""
    group = group or [P]
    order = order or [F.desc_nulls_last("date"), F.col("review_id")]
    return top_k(df, group, order, n)


def profile(df: DataFrame, order: str = "review_id", sample_chars: int = 60) -> DataFrame:
    """Per column: type, non-null count, first non-null value (text, cut)."""
    fields = [f for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    aggs = []
    for f in fields:
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"n__{f.name}"),
                 F.min_by(c.cast("string"), F.when(c.isNotNull(), F.col(order))).alias(f"s__{f.name}")]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.col(f"n__{f.name}").alias("non_null"), F.substring(F.col(f"s__{f.name}"), 1, sample_chars).alias("sample"))
        for f in fields
    ])
    return one.select(F.inline(rows))


def quotes(r: DataFrame, k: int = 6) -> DataFrame:
    """Per platform family, top-k Positive by score desc and Negative by score asc."""
    fam = with_family(r).filter(F.col("sentiment").isin("Positive", "Negative"))
    # score sign flipped for Negative so both use one ascending order
    key = F.when(F.col("sentiment") == "Positive", -F.col("sentiment_score")).otherwise(F.col("sentiment_score"))
    # only the cut text travels: each task keeps its k best of a group before the shuffle
    fam = fam.select(P, "family", "sentiment", "review_id", "sentiment_score", key.alias("_k"), snippet("review_text").alias("snippet"), stars("rating").alias("stars"))
    out = top_k(fam, [P, "family", "sentiment"], [F.col("_k"), F.col("review_id")], k)
    return out.select(P, "family", "sentiment", "rank", "review_id", "sentiment_score", "snippet", "stars")


def theme_quotes(r: DataFrame, k: int = 5) -> DataFrame:
    """Per theme, first k Positive and k Negative reviews in review order."""
    x = (r.filter(F.col("sentiment").isin("Positive", "Negative"))
         .select(P, "review_id", "sentiment", snippet("review_text").alias("snippet"), F.explode("themes").alias("theme")))
    out = top_k(x, [P, "theme", "sentiment"], [F.col("review_id")], k)
    return out.select(P, "theme", "sentiment", "rank", "review_id", "snippet")


def snippets(r: DataFrame, n: int = FV.QUOTE_CHARS) -> DataFrame:
    """Quote snippet and stars for every review."""
    return r.select(P, "review_id", snippet("review_text", n).alias("snippet"), stars("rating").alias("stars"))
