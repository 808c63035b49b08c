"""H: KPI, theme, platform aggregations over the scored reviews.

Input ``r`` is the scored frame (one row per review, ``themes`` array).
Every operator groups by ``product`` first, so all products are answered by
one job; theme aggregates ``explode`` the array (narrow) and aggregate with
map-side partial aggregation, so a hot product or theme is combined before
the exchange.  Windows appear only on the small aggregated results.

Averages of scores are taken over exact integers (scores carry at most four
decimals), which makes the rounded outputs independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.text import truthy

P = "product"


def _is(s: str) -> Column:
    return F.when(F.col("sentiment") == s, 1).otherwise(0)


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(100 * num / den, digits) in double arithmetic."""
    return F.round(F.lit(100.0) * num / den, digits)


def mean4(col: str) -> Column:
    """Mean of a 4-decimal score, order-independent (exact integer sum)."""
    units = F.sum(F.round(F.col(col) * 10000).cast("long"))
    return units.cast("double") / F.count(col) / F.lit(10000.0)


def sentiment_counts() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.sum(_is("Positive")).cast("long").alias("positive"),
        F.sum(_is("Negative")).cast("long").alias("negative"),
        F.sum(_is("Neutral")).cast("long").alias("neutral"),
    ]


def kpis(r: DataFrame) -> DataFrame:
    """H1: reviews, platforms, positive / negative share, avg rating or net."""
    a = r.groupBy(P).agg(
        F.count("*").alias("reviews"),
        F.countDistinct("platform").alias("platforms"),
        F.sum(_is("Positive")).alias("_pos"),
        F.sum(_is("Negative")).alias("_neg"),
        F.avg("rating").alias("_avg_rating"),
    )
    pos, neg = pct(F.col("_pos"), F.col("reviews")), pct(F.col("_neg"), F.col("reviews"))
    return a.select(
        P, "reviews", "platforms", pos.alias("positive_pct"), neg.alias("negative_pct"),
        F.round("_avg_rating", 2).alias("avg_rating"),
        F.when(F.col("_avg_rating").isNull(), F.round(pos - neg, 1)).alias("net_sentiment"),
    )


def sentiment_distribution(r: DataFrame) -> DataFrame:
    """H2: rows per sentiment, null sentiment excluded."""
    return r.filter(F.col("sentiment").isNotNull()).groupBy(P, "sentiment").agg(F.count("*").alias("n"))


def platform_sentiment(r: DataFrame) -> DataFrame:
    """H3: platform x sentiment counts."""
    return r.filter(F.col("sentiment").isNotNull()).groupBy(P, "platform", "sentiment").agg(F.count("*").alias("n"))


def sentiment_grouping_sets(r: DataFrame) -> DataFrame:
    """H2 + H3 in one pass: GROUPING SETS ((product, sentiment), (product, platform, sentiment)).

    ``level`` is 0 for platform rows (H3) and 1 for product totals (H2).
    """
    x = r.filter(F.col("sentiment").isNotNull())
    g = x.groupingSets([[P, "sentiment"], [P, "platform", "sentiment"]], P, "platform", "sentiment")
    return g.agg(F.count("*").alias("n"), (F.grouping_id() / 2).cast("int").alias("level"))


def _exploded(r: DataFrame, *cols: str) -> DataFrame:
    return r.select(P, "review_id", *cols, F.explode("themes").alias("theme"))


def theme_mentions(r: DataFrame, by: list[str] | None = None) -> DataFrame:
    """H4: mentions per theme (> 0 by construction), optionally per ``by``."""
    by = by or []
    return _exploded(r, *by).groupBy(P, *by, "theme").agg(F.count("*").alias("mentions"))


def theme_sentiment(r: DataFrame, min_n: int = 2) -> DataFrame:
    """H5: theme x {Positive, Negative, Neutral}, themes with >= min_n rows."""
    return (
        _exploded(r, "sentiment").groupBy(P, "theme").agg(*sentiment_counts())
        .filter(F.col("total") >= min_n)
    )


def theme_health(r: DataFrame, min_n: int = 2) -> DataFrame:
    """H6: (pos - neg) / n per theme with n >= min_n, plus taxonomy order."""
    a = _exploded(r, "product_type", "sentiment").groupBy(P, "product_type", "theme").agg(*sentiment_counts())
    from feedback_spark.operators.themes import theme_ord

    return (
        a.filter(F.col("total") >= min_n)
        .withColumn("score", (F.col("positive") - F.col("negative")).cast("double") / F.greatest(F.col("total"), F.lit(1)))
        .join(theme_ord(r.sparkSession), ["product_type", "theme"], "left")
        .drop("product_type", "neutral")
    )


def strengths_weaknesses(health: DataFrame, k: int = 3) -> DataFrame:
    """H7: top-k strengths (score > 0.1), bottom-k weaknesses (< -0.05).

    A product without strengths gets its k least negative themes as
    ``relative_strength``.  Ties: more mentions first, then taxonomy order.
    Windows run on the per-theme result (a few dozen rows per product).
    """
    best = Window.partitionBy(P).orderBy(F.desc("score"), F.desc("total"), "ord")
    worst = Window.partitionBy(P).orderBy("score", F.desc("total"), "ord")
    h = health.withColumn("_has_strength", F.max((F.col("score") > FV.STRENGTH_MIN).cast("int")).over(Window.partitionBy(P)))
    strong = (
        h.filter(F.col("score") > FV.STRENGTH_MIN).withColumn("rank", F.row_number().over(best))
        .withColumn("kind", F.lit("strength"))
    )
    relative = (
        h.filter(F.col("_has_strength") == 0).withColumn("rank", F.row_number().over(best))
        .withColumn("kind", F.lit("relative_strength"))
    )
    weak = (
        h.filter(F.col("score") < FV.WEAKNESS_MAX).withColumn("rank", F.row_number().over(worst))
        .withColumn("kind", F.lit("weakness"))
    )
    out = strong.unionByName(relative).unionByName(weak).filter(F.col("rank") <= k)
    pos_pct = F.bround(F.col("positive") / F.greatest(F.col("total"), F.lit(1)) * 100, 0).cast("long")
    neg_pct = F.bround(F.col("negative") / F.greatest(F.col("total"), F.lit(1)) * 100, 0).cast("long")
    return out.select(P, "kind", F.col("rank").cast("long").alias("rank"), "theme", "score", "total",
                      "positive", "negative", pos_pct.alias("positive_pct"), neg_pct.alias("negative_pct"))


def _badge(pos: Column, neg: Column) -> Column:
    return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("mixed")


def _tone(avg: Column) -> Column:
    return F.when(avg > FV.LABEL_THRESHOLD, "Positive").when(avg < -FV.LABEL_THRESHOLD, "Negative").otherwise("Neutral")


def theme_stats(r: DataFrame) -> DataFrame:
    """H8: per theme n, pos, neg, neu, avg score (3 dp), badge, tone."""
    a = _exploded(r, "sentiment", "sentiment_score").groupBy(P, "theme").agg(
        *sentiment_counts(), mean4("sentiment_score").alias("_avg")
    )
    avg = F.round("_avg", 3)
    return a.select(
        P, "theme", "total", "positive", "negative", "neutral", avg.alias("avg_sentiment"),
        _badge(F.col("positive"), F.col("negative")).alias("badge"), _tone(avg).alias("tone"),
    )


def theme_summary(r: DataFrame) -> DataFrame:
    """H9: H8 columns for every taxonomy theme of the product, zeros kept."""
    from feedback_spark.operators.themes import theme_ord

    # one pass over the reviews; a product then is one row that holds its themes' figures (bounded by the taxonomy)
    each = _with_mark(r, "product_type", "sentiment", "sentiment_score").groupBy(P, "theme").agg(
        *sentiment_counts(), F.round(mean4("sentiment_score"), 3).alias("avg_sentiment"), F.collect_set("product_type").alias("types"))
    names = ("total", "positive", "negative", "neutral", "avg_sentiment")
    product = each.groupBy(P).agg(F.collect_list(F.struct("theme", *names)).alias("cells"), F.array_distinct(F.flatten(F.collect_list("types"))).alias("types"))
    # products x their taxonomy: bounded by (#products x themes per type)
    grid = product.select(P, "cells", F.explode("types").alias("product_type")).join(theme_ord(r.sparkSession), "product_type")
    cell = F.try_element_at(F.filter("cells", lambda c: c["theme"] == F.col("theme")), F.lit(1))
    found = grid.select(P, "theme", "ord", cell.alias("c"))
    return found.select(P, "theme", "ord", *[F.coalesce(F.col(f"c.{c}"), F.lit(0)).cast("long").alias(c) for c in names[:4]], F.col("c.avg_sentiment").alias("avg_sentiment"))


def _with_mark(r: DataFrame, *cols: str) -> DataFrame:
    """One row per review and theme, and one with the theme '' for the review itself."""
    themes = F.concat(F.coalesce("themes", F.array().cast("array<string>")), F.array(F.lit("")))
    return r.select(P, *cols, F.explode(themes).alias("theme"))


def platform_summary(r: DataFrame, key: str = "platform") -> DataFrame:
    """Reviews, positive %, negative %, avg rating (1 dp) per platform."""
    a = r.groupBy(P, key).agg(
        F.count("*").alias("reviews"), F.sum(_is("Positive")).alias("_pos"),
        F.sum(_is("Negative")).alias("_neg"), F.avg("rating").alias("_r"),
    )
    return a.select(
        P, key, "reviews", pct(F.col("_pos"), F.col("reviews")).alias("positive_pct"),
        pct(F.col("_neg"), F.col("reviews")).alias("negative_pct"), F.round("_r", 1).alias("avg_rating"),
    )


def theme_platform_matrix(r: DataFrame) -> DataFrame:
    """Theme x platform counts incl. zeros; all-zero themes dropped (long form)."""
    # one pass over the reviews; a product then is one row that holds its cells (bounded by themes x platforms)
    counts = _with_mark(r.filter(F.col("platform").isNotNull()), "platform").groupBy(P, "theme", "platform").agg(F.count("*").alias("mentions"))
    product = counts.groupBy(P).agg(F.collect_list(F.struct("theme", "platform", "mentions")).alias("cells"), F.collect_set("platform").alias("platforms"),
                                    F.collect_set(F.when(F.col("theme") != "", F.col("theme"))).alias("themes"))
    grid = product.select(P, "cells", "platforms", F.explode("themes").alias("theme")).select(P, "cells", "theme", F.explode("platforms").alias("platform"))
    cell = F.try_element_at(F.filter("cells", lambda c: (c["theme"] == F.col("theme")) & (c["platform"] == F.col("platform"))), F.lit(1))
    return grid.select(P, "theme", "platform", F.coalesce(cell["mentions"], F.lit(0)).cast("long").alias("mentions"))


def theme_platform_pivot(r: DataFrame, platforms: list[str]) -> DataFrame:
    """H11 wide form: one column for each of ``platforms`` (the platform dimension; the columns are part of the plan)."""
    plats = sorted(platforms)
    return theme_mentions(r, ["platform"]).groupBy(P, "theme").pivot("platform", plats).agg(F.first("mentions")).na.fill(0)


def score_quartiles(r: DataFrame, by: str = "platform") -> DataFrame:
    """Min, quartiles (linear interpolation), max of sentiment_score.

    ``percentile`` keeps a value->count map per group; scores have at most
    20,001 distinct values, so the state is bounded for any group size.
    """
    s = F.col("sentiment_score")
    return r.filter(s.isNotNull()).groupBy(P, by).agg(
        F.min(s).alias("q0"),
        F.round(F.percentile(s, F.lit(0.25)), 6).alias("q1"),
        F.round(F.percentile(s, F.lit(0.5)), 6).alias("q2"),
        F.round(F.percentile(s, F.lit(0.75)), 6).alias("q3"),
        F.max(s).alias("q4"),
    )


def rating_histogram(r: DataFrame, min_rated: int = 5, key: str | None = None) -> DataFrame:
    """Rows per whole rating, for groups with more than ``min_rated`` rated rows."""
    keys = [P] + ([key] if key else [])
    rated = r.filter(F.col("rating").isNotNull())
    h = rated.groupBy(*keys, F.floor("rating").cast("long").alias("rating_bin")).agg(F.count("*").alias("n"))
    tot = h.groupBy(*keys).agg(F.sum("n").alias("_rated"))
    return h.join(tot, keys).filter(F.col("_rated") > min_rated).drop("_rated")


def theme_platforms(r: DataFrame) -> DataFrame:
    """Platform distribution inside each theme."""
    return theme_mentions(r, ["platform"]).withColumnRenamed("mentions", "n")


def share_of_max(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Value / max(value) within the group (on a small result)."""
    by = by or [P]
    w = Window.partitionBy(*by)
    return df.withColumn("share", F.col(col).cast("double") / F.greatest(F.max(col).over(w), F.lit(1)))


PLATFORM_FAMILIES = ["trustpilot", "twitter", "reddit", "playstore", "google_maps", "app_store"]
#: The family of platforms that no key names.
REST_FAMILY = "other"


def platform_family(r: DataFrame, key: str) -> DataFrame:
    """Rows whose platform contains ``key`` (case-insensitive substring)."""
    return r.filter(F.lower("platform").contains(key.lower()))


def with_family(r: DataFrame, families: list[str] | None = None) -> DataFrame:
    """All families at once: a row joins every family whose key its platform contains, or the rest group."""
    fam = F.filter(F.array(*[F.when(F.lower("platform").contains(k.lower()), F.lit(k)) for k in families or PLATFORM_FAMILIES]),
                   lambda x: x.isNotNull())
    return r.withColumn("family", fam).withColumn("family", F.explode(F.when(F.size("family") > 0, F.col("family")).otherwise(F.array(F.lit(REST_FAMILY)))))


def family_dimension(r: DataFrame, families: list[str] | None = None) -> DataFrame:
    """(family, platform, n) of the platforms that occur: which family each belongs to."""
    counted = r.groupBy("platform").agg(F.count("*").alias("n"))
    return with_family(counted, families).select("family", "platform", "n")


def platform_panel(r: DataFrame, families: list[str] | None = None) -> DataFrame:
    """Per platform family (every platform belongs to one): reviews, positive %, negative %, avg rating."""
    return platform_summary(with_family(r, families), "family")


def flag_totals(r: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """Number of rows with each flag set (true / "True" / "1")."""
    flags = flags or FV.ENRICH_BOOL_FIELDS
    return r.groupBy(P).agg(*[F.sum(truthy(f).cast("int")).cast("long").alias(f) for f in flags])


def breakdowns(r: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Value counts of several columns in one pass (long form via ``stack``)."""
    cols = cols or ["priority", "sentiment", "churn_risk"]
    stacked = r.select(P, F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols
    ])))
    return stacked.filter(F.col("value").isNotNull()).groupBy(P, "field", "value").agg(F.count("*").alias("n"))
