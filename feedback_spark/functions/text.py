"""Column-level helpers (all built-in expressions, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import SPACE_CHARS, portable


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_text(col: str | Column) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``)."""
    # a look at both ends, not a pattern tried at every blank of the text
    return F.btrim(_c(col), F.lit(SPACE_CHARS))


def clean_date(col: str | Column) -> Column:
    """Date coercion per row; unparsable text becomes null."""
    c = _c(col)
    return F.try_to_date(c.cast("string"))


def clean_rating(col: str | Column) -> Column:
    """Numeric rating or null (``try_cast`` so bad text never raises)."""
    return _c(col).cast("string").try_cast("double")


def matches(text_lc: Column, pattern: str) -> Column:
    """Contains-test of a Python-syntax pattern against lower-cased text."""
    return text_lc.rlike(portable(pattern))


def label(score: str | Column, thr: float = FV.LABEL_THRESHOLD) -> Column:
    """Positive / Negative / Neutral from a polarity score."""
    s = _c(score)
    return F.when(s >= thr, "Positive").when(s <= -thr, "Negative").otherwise("Neutral")


def label_to_score(col: str | Column) -> Column:
    """LLM label to score; anything else, null included, is 0.0."""
    lc = F.lower(_c(col))
    expr = F.lit(0.0)
    for name, val in FV.LLM_LABEL_SCORES.items():
        expr = F.when(lc == name, F.lit(val)).otherwise(expr)
    return expr


def snippet(col: str | Column, n: int = FV.QUOTE_CHARS) -> Column:
    """First n characters plus an ellipsis when cut."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def stars(rating: str | Column) -> Column:
    """One star per whole rating point; empty for null."""
    r = _c(rating)
    return F.when(r.isNull() | (r < 1), F.lit("")).otherwise(F.repeat(F.lit("⭐"), r.cast("int")))


def strip_fences(col: str | Column) -> Column:
    """K8: trim, drop a leading ```json / ``` fence and a trailing fence, trim."""
    t = clean_text(_c(col))
    t = F.regexp_replace(t, r"^```(?:json)?[\t\n\x0B\f\r ]*", "")
    t = F.regexp_replace(t, r"[\t\n\x0B\f\r ]*```$", "")
    return clean_text(t)


def between_fences(col: str | Column) -> Column:
    """K8, agent route: of a text that begins with a fence, what stands before the next one, without a leading ``json``."""
    t = clean_text(_c(col))
    inner = F.split_part(t, F.lit("```"), F.lit(2))
    inner = clean_text(F.regexp_replace(inner, "^json", ""))
    return F.when(t.startswith("```"), inner).otherwise(t)


def flatten_themes(col: str | Column) -> Column:
    """Theme array to the ``a | b`` text form."""
    return F.concat_ws(" | ", _c(col))


def parse_themes(col: str | Column, strict: bool = False) -> Column:
    """LLM themes text to an array.

    ``[..]`` text is read as a JSON list; otherwise the pipe-joined form is
    split.  ``strict=True`` reproduces the original reader, which only
    understood the list form and gave an empty list for pipe-joined text.
    """
    c = clean_text(_c(col))
    # JSON with either quote; only text that is none is re-quoted (an apostrophe inside a name must survive)
    as_list = F.coalesce(F.from_json(c, "array<string>"), F.from_json(F.regexp_replace(c, "'", '"'), "array<string>"))
    parts = F.filter(F.split(c, r"[\t ]*\|[\t ]*"), lambda x: F.length(x) > 0)
    empty = F.array().cast("array<string>")
    listy = c.startswith("[")
    if strict:
        return F.when(c.isNull(), empty).when(listy, F.coalesce(as_list, empty)).otherwise(empty)
    return F.when(c.isNull() | (c == ""), empty).when(listy, F.coalesce(as_list, empty)).otherwise(parts)


def truthy(col: str | Column) -> Column:
    """True / "True" / "1" count as set; anything else, null included, is false."""
    return F.coalesce(F.lower(_c(col).cast("string")).isin("true", "1"), F.lit(False))
