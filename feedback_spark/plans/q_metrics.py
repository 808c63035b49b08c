"""Registered queries H1-H18 (Spark plan + DuckDB oracle SQL)."""

from __future__ import annotations

from feedback_spark.operators import metrics as M
from feedback_spark.plans.base import scored_layer
from feedback_spark.plans.sql_base import with_base

POS = "CASE WHEN sentiment = 'Positive' THEN 1 ELSE 0 END"
NEG = "CASE WHEN sentiment = 'Negative' THEN 1 ELSE 0 END"
NEU = "CASE WHEN sentiment = 'Neutral' THEN 1 ELSE 0 END"
COUNTS = (f"count(*) AS total, CAST(sum({POS}) AS BIGINT) AS positive, "
          f"CAST(sum({NEG}) AS BIGINT) AS negative, CAST(sum({NEU}) AS BIGINT) AS neutral")
MEAN4 = "CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS DOUBLE) / count(sentiment_score) / 10000.0"
EXPL = "SELECT s.*, unnest(s.themes) AS theme FROM scored s"


def _pct(num: str, den: str, d: int = 1) -> str:
    return f"round(CAST(100.0 AS DOUBLE) * {num} / {den}, {d})"


HEALTH_CTES = f"""
, h AS (
  SELECT h.product, h.theme, total, positive, negative,
         CAST(positive - negative AS DOUBLE) / greatest(total, 1) AS score, t.ord
  FROM (SELECT product, product_type, theme, {COUNTS} FROM ({EXPL}) GROUP BY ALL HAVING count(*) >= 2) h
  LEFT JOIN taxo t ON t.product_type = h.product_type AND t.theme = h.theme),
hs AS (SELECT *, max(CASE WHEN score > 0.1 THEN 1 ELSE 0 END) OVER (PARTITION BY product) AS has_s FROM h)"""


def _q(fn):
    return lambda spark, sf: fn(scored_layer(spark, sf))


#: Platform dimension of the wide H11 table.
PIVOT_PLATFORMS = [*M.FV.ADAPTER_PLATFORMS, "google_maps"]

QUERIES = {
    "h1_kpis": (
        _q(M.kpis),
        with_base(f"""
SELECT product, reviews, platforms, positive_pct, negative_pct, round(_r, 2) AS avg_rating,
       CASE WHEN _r IS NULL THEN round(positive_pct - negative_pct, 1) END AS net_sentiment
FROM (SELECT product, count(*) AS reviews, count(DISTINCT platform) AS platforms,
             {_pct(f'sum({POS})', 'count(*)')} AS positive_pct, {_pct(f'sum({NEG})', 'count(*)')} AS negative_pct,
             avg(rating) AS _r
      FROM scored GROUP BY product)"""),
    ),
    "h2_sentiment_distribution": (
        _q(M.sentiment_distribution),
        with_base("SELECT product, sentiment, count(*) AS n FROM scored WHERE sentiment IS NOT NULL GROUP BY ALL"),
    ),
    "h3_platform_sentiment": (
        _q(M.platform_sentiment),
        with_base("SELECT product, platform, sentiment, count(*) AS n FROM scored WHERE sentiment IS NOT NULL GROUP BY ALL"),
    ),
    "h2_h3_grouping_sets": (
        _q(M.sentiment_grouping_sets),
        with_base("SELECT product, platform, sentiment, count(*) AS n, CAST(grouping(platform) AS INTEGER) AS level "
                  "FROM scored WHERE sentiment IS NOT NULL "
                  "GROUP BY GROUPING SETS ((product, sentiment), (product, platform, sentiment))"),
    ),
    "h4_theme_mentions": (
        _q(M.theme_mentions),
        with_base(f"SELECT product, theme, count(*) AS mentions FROM ({EXPL}) GROUP BY ALL"),
    ),
    "h4_theme_mentions_by_platform": (
        _q(lambda r: M.theme_mentions(r, ["platform"])),
        with_base(f"SELECT product, platform, theme, count(*) AS mentions FROM ({EXPL}) GROUP BY ALL"),
    ),
    "h5_theme_sentiment": (
        _q(M.theme_sentiment),
        with_base(f"SELECT product, theme, {COUNTS} FROM ({EXPL}) GROUP BY ALL HAVING count(*) >= 2"),
    ),
    "h6_theme_health": (
        _q(M.theme_health),
        with_base(f"""
SELECT h.product, h.theme, total, positive, negative,
       CAST(positive - negative AS DOUBLE) / greatest(total, 1) AS score, t.ord
FROM (SELECT product, product_type, theme, {COUNTS} FROM ({EXPL}) GROUP BY ALL HAVING count(*) >= 2) h
LEFT JOIN taxo t ON t.product_type = h.product_type AND t.theme = h.theme"""),
    ),
    "h7_strengths_weaknesses": (
        _q(lambda r: M.strengths_weaknesses(M.theme_health(r))),
        with_base(HEALTH_CTES + """,
u AS (
  SELECT *, 'strength' AS kind, row_number() OVER (PARTITION BY product ORDER BY score DESC, total DESC, ord) AS rank
  FROM hs WHERE score > 0.1
  UNION ALL
  SELECT *, 'relative_strength', row_number() OVER (PARTITION BY product ORDER BY score DESC, total DESC, ord)
  FROM hs WHERE has_s = 0
  UNION ALL
  SELECT *, 'weakness', row_number() OVER (PARTITION BY product ORDER BY score, total DESC, ord)
  FROM hs WHERE score < -0.05)
SELECT product, kind, CAST(rank AS BIGINT) AS rank, theme, score, total, positive, negative,
       CAST(round_even(positive / greatest(total, 1) * 100, 0) AS BIGINT) AS positive_pct,
       CAST(round_even(negative / greatest(total, 1) * 100, 0) AS BIGINT) AS negative_pct
FROM u WHERE rank <= 3"""),
    ),
    "h8_theme_stats": (
        _q(M.theme_stats),
        with_base(f"""
SELECT product, theme, total, positive, negative, neutral, round(_avg, 3) AS avg_sentiment,
       CASE WHEN positive > negative THEN 'positive' WHEN negative > positive THEN 'negative' ELSE 'mixed' END AS badge,
       CASE WHEN round(_avg, 3) > 0.05 THEN 'Positive' WHEN round(_avg, 3) < -0.05 THEN 'Negative' ELSE 'Neutral' END AS tone
FROM (SELECT product, theme, {COUNTS}, {MEAN4} AS _avg FROM ({EXPL}) GROUP BY ALL)"""),
    ),
    "h9_theme_summary": (
        _q(M.theme_summary),
        with_base(f"""
SELECT g.product, g.theme, g.ord, coalesce(s.total, 0) AS total, coalesce(s.positive, 0) AS positive,
       coalesce(s.negative, 0) AS negative, coalesce(s.neutral, 0) AS neutral, s.avg_sentiment
FROM (SELECT DISTINCT p.product, t.theme, t.ord FROM (SELECT DISTINCT product, product_type FROM scored) p
      JOIN taxo t ON t.product_type = p.product_type) g
LEFT JOIN (SELECT product, theme, {COUNTS}, round({MEAN4}, 3) AS avg_sentiment FROM ({EXPL}) GROUP BY ALL) s
  ON s.product = g.product AND s.theme = g.theme"""),
    ),
    "h10_platform_summary": (
        _q(M.platform_summary),
        with_base(f"""
SELECT product, platform, count(*) AS reviews, {_pct(f'sum({POS})', 'count(*)')} AS positive_pct,
       {_pct(f'sum({NEG})', 'count(*)')} AS negative_pct, round(avg(rating), 1) AS avg_rating
FROM scored GROUP BY ALL"""),
    ),
    "h11_theme_platform_matrix": (
        _q(M.theme_platform_matrix),
        with_base(f"""
, c AS (SELECT product, theme, platform, count(*) AS mentions FROM ({EXPL}) GROUP BY ALL)
SELECT t.product, t.theme, p.platform, coalesce(c.mentions, 0) AS mentions
FROM (SELECT DISTINCT product, theme FROM c) t
JOIN (SELECT DISTINCT product, platform FROM scored) p ON p.product = t.product
LEFT JOIN c ON c.product = t.product AND c.theme = t.theme AND c.platform = p.platform"""),
    ),
    "h11_theme_platform_pivot": (
        _q(lambda r: M.theme_platform_pivot(r, PIVOT_PLATFORMS)),
        with_base(f"""
SELECT product, theme, {', '.join(f"CAST(coalesce(sum(CASE WHEN platform = '{p}' THEN 1 END), 0) AS BIGINT) AS {p}" for p in sorted(PIVOT_PLATFORMS))}
FROM ({EXPL}) GROUP BY product, theme"""),
    ),
    "h12_score_quartiles": (
        _q(M.score_quartiles),
        with_base("""
SELECT product, platform, min(sentiment_score) AS q0,
       round(quantile_cont(sentiment_score, 0.25), 6) AS q1, round(quantile_cont(sentiment_score, 0.5), 6) AS q2,
       round(quantile_cont(sentiment_score, 0.75), 6) AS q3, max(sentiment_score) AS q4
FROM scored WHERE sentiment_score IS NOT NULL GROUP BY ALL"""),
    ),
    "h13_rating_histogram": (
        _q(M.rating_histogram),
        with_base("""
SELECT product, rating_bin, n FROM (
  SELECT product, CAST(floor(rating) AS BIGINT) AS rating_bin, count(*) AS n,
         sum(count(*)) OVER (PARTITION BY product) AS rated
  FROM scored WHERE rating IS NOT NULL GROUP BY product, CAST(floor(rating) AS BIGINT)) WHERE rated > 5"""),
    ),
    "h14_theme_platforms": (
        _q(M.theme_platforms),
        with_base(f"SELECT product, platform, theme, count(*) AS n FROM ({EXPL}) GROUP BY ALL"),
    ),
    "h17_share_of_max": (
        _q(lambda r: M.share_of_max(M.theme_mentions(r), "mentions")),
        with_base(f"""
SELECT product, theme, mentions, CAST(mentions AS DOUBLE) / greatest(max(mentions) OVER (PARTITION BY product), 1) AS share
FROM (SELECT product, theme, count(*) AS mentions FROM ({EXPL}) GROUP BY ALL)"""),
    ),
    "h18_platform_panel": (
        _q(M.platform_panel),
        with_base(f"""
, f AS (SELECT s.*, unnest(list_filter([{', '.join(f"CASE WHEN contains(lower(platform), '{k}') THEN '{k}' END" for k in M.PLATFORM_FAMILIES)}], lambda x: x IS NOT NULL)) AS family FROM scored s)
SELECT product, family, count(*) AS reviews, {_pct(f'sum({POS})', 'count(*)')} AS positive_pct,
       {_pct(f'sum({NEG})', 'count(*)')} AS negative_pct, round(avg(rating), 1) AS avg_rating
FROM f GROUP BY ALL"""),
    ),
}
