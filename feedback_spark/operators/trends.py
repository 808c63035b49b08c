"""I: time buckets and trends (group-bys on a derived period column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedback_spark.operators.metrics import mean4

P = "product"


def period(col: str | Column, grain: str = "month") -> Column:
    """``yyyy-MM`` for months; ``<monday>/<sunday>`` for weeks."""
    c = F.col(col) if isinstance(col, str) else col
    if grain == "month":
        return F.date_format(c, "yyyy-MM")
    if grain == "week":
        start = F.date_trunc("week", c).cast("date")
        return F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("/"), F.date_format(F.date_add(start, 6), "yyyy-MM-dd"))
    raise ValueError(grain)


def _dated(r: DataFrame, grain: str) -> DataFrame:
    return r.filter(F.col("date").isNotNull()).withColumn("period", period("date", grain))


def volume_by_platform(r: DataFrame, grain: str = "month") -> DataFrame:
    """Reviews per period x platform."""
    return _dated(r, grain).groupBy(P, "period", "platform").agg(F.count("*").alias("n"))


def volume_by_sentiment(r: DataFrame, grain: str = "month") -> DataFrame:
    """Reviews per period x sentiment (null sentiment excluded)."""
    return (_dated(r, grain).filter(F.col("sentiment").isNotNull())
            .groupBy(P, "period", "sentiment").agg(F.count("*").alias("n")))


def mean_score(r: DataFrame, grain: str = "month", rolling: int | None = 3) -> DataFrame:
    """I4: mean score per period; ``rolling`` adds a trailing mean of period means."""
    out = _dated(r, grain).groupBy(P, "period").agg(mean4("sentiment_score").alias("avg_score"))
    if rolling:
        w = Window.partitionBy(P).orderBy("period").rowsBetween(-(rolling - 1), 0)  # small per-period result
        # rounded: a window mean's last bits depend on the summation order
        out = out.withColumn("rolling_avg", F.round(F.avg("avg_score").over(w), 9))
    return out


def theme_frequency(r: DataFrame, grain: str = "month", themes: list[str] | None = None, first_n: int = 3) -> DataFrame:
    """Mentions per period for chosen themes (default: first ``first_n`` of each taxonomy)."""
    from feedback_spark.operators.themes import theme_ord

    x = _dated(r, grain).select(P, "product_type", "period", F.explode("themes").alias("theme"))
    if themes:
        x = x.filter(F.col("theme").isin(themes))
    else:
        x = x.join(theme_ord(r.sparkSession), ["product_type", "theme"]).filter(F.col("ord") <= first_n)
    return x.groupBy(P, "period", "theme").agg(F.count("*").alias("n"))


def theme_sentiment_trend(r: DataFrame) -> DataFrame:
    """Theme x month x sentiment."""
    x = _dated(r, "month").filter(F.col("sentiment").isNotNull())
    return (x.select(P, "period", "sentiment", F.explode("themes").alias("theme"))
            .groupBy(P, "theme", "period", "sentiment").agg(F.count("*").alias("n")))


def platform_volume(r: DataFrame) -> DataFrame:
    """Platform x month volume."""
    return _dated(r, "month").groupBy(P, "platform", "period").agg(F.count("*").alias("n"))


def date_range(r: DataFrame, start: str, end: str) -> DataFrame:
    """I8: inclusive date filter; null dates removed (pushes down to Parquet)."""
    return r.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def date_bounds(r: DataFrame) -> DataFrame:
    """First and last date per product."""
    return r.groupBy(P).agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
