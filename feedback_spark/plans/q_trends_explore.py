"""Registered queries I1-I9 and J1-J10 (Spark plan + DuckDB oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedback_spark.functions.regex import portable, sql_str
from feedback_spark.operators import explore as J
from feedback_spark.operators import trends as T
from feedback_spark.operators.metrics import PLATFORM_FAMILIES
from feedback_spark.plans.base import scored_layer
from feedback_spark.plans.sql_base import with_base

MONTH = "strftime(date, '%Y-%m')"
WEEK_START = "CAST(date_trunc('week', date) AS DATE)"
WEEK = f"strftime({WEEK_START}, '%Y-%m-%d') || '/' || strftime({WEEK_START} + 6, '%Y-%m-%d')"
MEAN4 = "CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment_score) / 10000.0"
SNIP = "CASE WHEN length(review_text) > 350 THEN substr(review_text, 1, 350) || '…' ELSE review_text END"
STARS = "CASE WHEN rating IS NULL OR rating < 1 THEN '' ELSE repeat('⭐', CAST(trunc(rating) AS INTEGER)) END"
FAMILY = ("unnest(list_filter([" + ", ".join(
    f"CASE WHEN contains(lower(platform), '{k}') THEN '{k}' END" for k in PLATFORM_FAMILIES) + "], lambda x: x IS NOT NULL))")

SEARCH_PATTERN = r"refund|cancel(l?ed)?\s+my"
ANY_PATTERN = r"user_1[0-3]$|^2024-02|broker sync"
ANY_COLS = ["product", "platform", "author", "review_text", "sentiment", "date"]
PROFILE_COLS = [
    ("review_id", "bigint"), ("product", "string"), ("product_type", "string"), ("platform", "string"),
    ("date", "date"), ("author", "string"), ("rating", "double"), ("review_text", "string"),
    ("source_url", "string"), ("sentiment_raw", "double"), ("sentiment", "string"),
    ("sentiment_score", "double"), ("sentiment_corrected", "boolean"),
]


def _q(fn):
    return lambda spark, sf: fn(scored_layer(spark, sf))


def _ci_sql(p: str) -> str:
    return sql_str("(?i)" + portable(p))


def _profile_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, "
        f"substr(CAST(first({c} ORDER BY review_id) FILTER (WHERE {c} IS NOT NULL) AS VARCHAR), 1, 60) AS sample FROM scored"
        for c, t in PROFILE_COLS
    ]
    return "\nUNION ALL\n".join(parts)


def _profile(r):
    return J.profile(r.select(*[c for c, _ in PROFILE_COLS]))


QUERIES = {
    "i1_period_week": (
        _q(lambda r: r.filter(F.col("date").isNotNull()).select("product", "review_id", T.period("date", "month").alias("month"),
                                                               T.period("date", "week").alias("week"))),
        with_base(f"SELECT product, review_id, {MONTH} AS month, {WEEK} AS week FROM scored WHERE date IS NOT NULL"),
    ),
    "i2_volume_by_platform": (
        _q(T.volume_by_platform),
        with_base(f"SELECT product, {MONTH} AS period, platform, count(*) AS n FROM scored WHERE date IS NOT NULL GROUP BY ALL"),
    ),
    "i2_volume_by_platform_weekly": (
        _q(lambda r: T.volume_by_platform(r, "week")),
        with_base(f"SELECT product, {WEEK} AS period, platform, count(*) AS n FROM scored WHERE date IS NOT NULL GROUP BY ALL"),
    ),
    "i3_volume_by_sentiment": (
        _q(T.volume_by_sentiment),
        with_base(f"SELECT product, {MONTH} AS period, sentiment, count(*) AS n FROM scored "
                  "WHERE date IS NOT NULL AND sentiment IS NOT NULL GROUP BY ALL"),
    ),
    "i4_mean_score": (
        _q(T.mean_score),
        with_base(f"""
SELECT product, period, avg_score,
       round(avg(avg_score) OVER (PARTITION BY product ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS rolling_avg
FROM (SELECT product, {MONTH} AS period, {MEAN4} AS avg_score FROM scored WHERE date IS NOT NULL GROUP BY ALL)"""),
    ),
    "i5_theme_frequency": (
        _q(T.theme_frequency),
        with_base(f"""
SELECT product, period, x.theme, count(*) AS n
FROM (SELECT product, product_type, {MONTH} AS period, unnest(themes) AS theme FROM scored WHERE date IS NOT NULL) x
JOIN taxo t ON t.product_type = x.product_type AND t.theme = x.theme
WHERE t.ord <= 3 GROUP BY ALL"""),
    ),
    "i6_theme_sentiment_trend": (
        _q(T.theme_sentiment_trend),
        with_base(f"""
SELECT product, theme, period, sentiment, count(*) AS n
FROM (SELECT product, {MONTH} AS period, sentiment, unnest(themes) AS theme FROM scored
      WHERE date IS NOT NULL AND sentiment IS NOT NULL) GROUP BY ALL"""),
    ),
    "i7_platform_volume": (
        _q(T.platform_volume),
        with_base(f"SELECT product, platform, {MONTH} AS period, count(*) AS n FROM scored WHERE date IS NOT NULL GROUP BY ALL"),
    ),
    "i8_date_range": (
        _q(lambda r: T.date_range(r, "2024-03-01", "2024-12-31").select("product", "review_id", "date")),
        with_base("SELECT product, review_id, date FROM scored WHERE date BETWEEN DATE '2024-03-01' AND DATE '2024-12-31'"),
    ),
    "i9_date_bounds": (
        _q(T.date_bounds),
        with_base("SELECT product, min(date) AS min_date, max(date) AS max_date FROM scored GROUP BY product"),
    ),
    "j1_facet_filter": (
        _q(lambda r: J.facet_filter(r, ["reddit", "trustpilot", "twitter"], ["Negative", "Neutral", None])
           .select("product", "review_id", "platform", "sentiment")),
        with_base("SELECT product, review_id, platform, sentiment FROM scored "
                  "WHERE platform IN ('reddit', 'trustpilot', 'twitter') AND (sentiment IN ('Negative', 'Neutral') OR sentiment IS NULL)"),
    ),
    "j2_search_text": (
        _q(lambda r: J.search_text(r, SEARCH_PATTERN).select("product", "review_id")),
        with_base(f"SELECT product, review_id FROM scored WHERE regexp_matches(review_text, {_ci_sql(SEARCH_PATTERN)})"),
    ),
    "j2_search_boundaries": (
        _q(lambda r: J.search_text(r, r"refund|\bslow|(\bapp|\bsync) ").select("product", "review_id")),
        with_base("SELECT product, review_id FROM scored WHERE regexp_matches(lower(review_text), "
                  r"'refund|(^|[^\p{L}\p{N}_])slow|(^|[^\p{L}\p{N}_])(app|sync) ')"),
    ),
    "j2_search_literal": (
        _q(lambda r: J.search_text(r, "Edgewonk but", literal=True).select("product", "review_id")),
        with_base("SELECT product, review_id FROM scored WHERE contains(lower(review_text), 'edgewonk but')"),
    ),
    "j3_search_any": (
        _q(lambda r: J.search_any(r, ANY_PATTERN, ANY_COLS).select("product", "review_id")),
        with_base("SELECT product, review_id FROM scored WHERE "
                  + " OR ".join(f"regexp_matches(CAST({c} AS VARCHAR), {_ci_sql(ANY_PATTERN)})" for c in ANY_COLS)),
    ),
    "j4_review_listing": (
        _q(lambda r: J.review_listing(r, ["date", "platform", "rating", "sentiment"])),
        with_base("SELECT product, review_id, date, platform, rating, sentiment FROM scored"),
    ),
    "j5_head": (
        _q(lambda r: J.head(r, 10).select("product", "rank", "review_id", "date")),
        with_base("""
SELECT product, rank, review_id, date FROM (
  SELECT product, review_id, date,
         CAST(row_number() OVER (PARTITION BY product ORDER BY date DESC NULLS LAST, review_id) AS BIGINT) AS rank
  FROM scored) WHERE rank <= 10"""),
    ),
    "j6_profile": (_q(_profile), with_base(_profile_sql())),
    "j7_platform_family": (
        _q(lambda r: J.with_family(r).select("product", "review_id", "platform", "family")),
        with_base(f"SELECT product, review_id, platform, {FAMILY} AS family FROM scored"),
    ),
    "j8_quotes": (
        _q(J.quotes),
        with_base(f"""
SELECT product, family, sentiment, rank, review_id, sentiment_score, {SNIP} AS snippet, {STARS} AS stars FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product, family, sentiment
                 ORDER BY CASE WHEN sentiment = 'Positive' THEN -sentiment_score ELSE sentiment_score END, review_id) AS BIGINT) AS rank
  FROM (SELECT *, {FAMILY} AS family FROM scored) WHERE sentiment IN ('Positive', 'Negative')) WHERE rank <= 6"""),
    ),
    "j9_theme_quotes": (
        _q(J.theme_quotes),
        with_base(f"""
SELECT product, theme, sentiment, rank, review_id, {SNIP} AS snippet FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product, theme, sentiment ORDER BY review_id) AS BIGINT) AS rank
  FROM (SELECT product, review_id, sentiment, review_text, unnest(themes) AS theme FROM scored
        WHERE sentiment IN ('Positive', 'Negative'))) WHERE rank <= 5"""),
    ),
    "j10_snippets": (
        _q(J.snippets),
        with_base(f"SELECT product, review_id, {SNIP} AS snippet, {STARS} AS stars FROM scored"),
    ),
}
