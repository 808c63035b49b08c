"""Registered queries C1-C9, D1-D7, E1-E4 (Spark plan + DuckDB oracle SQL)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import sql_str
from feedback_spark.functions.text import clean_date, clean_rating, clean_text, label, label_to_score, parse_themes
from feedback_spark.operators import clean as C
from feedback_spark.operators import sentiment as D
from feedback_spark.operators import themes as E
from feedback_spark.plans.base import clean_layer, scored_layer
from feedback_spark.plans.sql_base import scoring_ctes, rx, trim_sql, with_base
from feedback_spark.sources.testdata import products, reviews, table

ALL_THEMES = list(dict.fromkeys(t for lst in FV.THEME_PATTERNS.values() for t, _ in lst))


def conversation_reviews(spark, sf):
    """Turns of ``conversations`` as review rows of one more source."""
    c = table(spark, sf, "conversations")
    return c.select(
        (F.lit(10**12) + F.col("conv_id") * 1000 + F.col("turn")).alias("review_id"),
        F.lit("google_maps").alias("platform"),
        F.col("text").alias("review_text"),
    )


CONV_SQL = ("SELECT 1000000000000 + conv_id * 1000 + turn AS review_id, 'google_maps' AS platform, text AS review_text "
            "FROM conversations")


def _c1(spark, sf):
    r = reviews(spark, sf).select("review_id", "platform", "date", "rating", "review_text")
    u = C.unify([r, conversation_reviews(spark, sf)])
    return u.groupBy("platform").agg(F.count("*").alias("n"), F.count("rating").alias("rated"))


def _padded(spark, sf):
    d = table(spark, sf, "documents")
    pad = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(F.lit("  "), F.col("text"), F.lit(" \n "))).otherwise(F.col("text"))
    return d.select("doc_id", pad.alias("raw"))


PADDED_SQL = ("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN chr(160) || ' ' || text || ' ' || chr(10) || chr(8195) "
              "ELSE text END AS raw FROM documents")


def _dates(spark, sf):
    d = table(spark, sf, "documents")
    iso = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(700)).cast("int")), "yyyy-MM-dd")
    k = F.pmod("doc_id", F.lit(4))
    raw = F.when(k == 0, iso).when(k == 1, F.lit("2 weeks ago")).when(k == 2, F.lit(None).cast("string")).otherwise(F.lit(""))
    return d.select("doc_id", raw.alias("raw_date"))


DATES_SQL = ("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN strftime(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%d') "
             "WHEN 1 THEN '2 weeks ago' WHEN 2 THEN NULL ELSE '' END AS raw_date FROM documents")


def _ratings(spark, sf):
    d = table(spark, sf, "documents")
    k = F.pmod("doc_id", F.lit(5))
    raw = (F.when(k == 0, F.lit("x")).when(k == 1, F.lit("")).when(k == 2, F.lit(None).cast("string"))
           .when(k == 3, F.lit("2.5")).otherwise((F.pmod("doc_id", F.lit(5)) + 1).cast("string")))
    return d.select("doc_id", raw.alias("raw_rating"))


RATINGS_SQL = ("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '2.5' "
               "ELSE CAST(1 + doc_id % 5 AS VARCHAR) END AS raw_rating FROM documents")


def llm_labels(spark, sf):
    """Stand-in LLM sentiment labels from the ``labels`` table."""
    lab = table(spark, sf, "labels")
    return lab.select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, "Positive").otherwise("Neutral").alias("llm_sentiment"),
    )


LLM_SQL = ("SELECT doc_id AS review_id, CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' "
           "ELSE 'Neutral' END AS llm_sentiment FROM labels")


def _d7(spark, sf):
    r = clean_layer(spark, sf).join(llm_labels(spark, sf), "review_id", "left")
    s = D.score_sentiment(r, products(spark))
    return s.select("product", "review_id", "sentiment_lane", "sentiment", "sentiment_score")


def _d7_sql() -> str:
    use = " OR ".join(f"product = {sql_str(p)}" for p, _, _, u in FV.PRODUCTS if u) or "FALSE"
    return with_base(f"""
, j AS (SELECT s.*, l.llm_sentiment FROM scored s LEFT JOIN ({LLM_SQL}) l ON l.review_id = s.review_id),
fl AS (SELECT product, (({use}) AND bool_or(llm_sentiment IS NOT NULL)) AS llm FROM j GROUP BY product)
SELECT j.product, review_id, CASE WHEN fl.llm THEN 'llm' ELSE 'lexicon' END AS sentiment_lane,
       CASE WHEN fl.llm THEN llm_sentiment ELSE sentiment END AS sentiment,
       CASE WHEN fl.llm THEN (CASE WHEN lower(llm_sentiment) = 'positive' THEN 0.5
                                   WHEN lower(llm_sentiment) = 'negative' THEN -0.5 ELSE 0.0 END)
            ELSE sentiment_score END AS sentiment_score
FROM j JOIN fl ON fl.product = j.product""")


def _stem_sql_hits() -> str:
    return ", ".join(
        f"CASE WHEN product_type = {sql_str(pt)} AND {rx('lower(review_text)', E._stem(p))} THEN {sql_str(theme)} END"
        for pt, lst in FV.THEME_PATTERNS.items() for theme, p in lst
    )


def _e3(spark, sf):
    r = scored_layer(spark, sf)
    themes = F.concat("themes", F.array(F.lit("Driver's attitude")))
    txt = F.when(F.pmod("review_id", F.lit(2)) == 0, F.concat_ws(" | ", themes)).otherwise(F.to_json(themes))
    return (r.select("product", "review_id", parse_themes(txt).alias("parsed"))
            .select("product", "review_id", F.explode("parsed").alias("theme")))


E3_SQL = with_base(r"""
, tx AS (SELECT product, review_id, CASE WHEN review_id % 2 = 0 THEN array_to_string(list_append(themes, 'Driver''s attitude'), ' | ')
                                          ELSE CAST(to_json(list_append(themes, 'Driver''s attitude')) AS VARCHAR) END AS t FROM scored),
px AS (SELECT product, review_id, CASE WHEN t IS NULL OR t = '' THEN []::VARCHAR[]
                                        WHEN starts_with(t, '[') THEN from_json(t, '["VARCHAR"]')
                                        ELSE list_filter(string_split_regex(t, '[\t ]*\|[\t ]*'), lambda x: length(x) > 0) END AS parsed
       FROM tx)
SELECT product, review_id, unnest(parsed) AS theme FROM px""")


def _q(fn):
    return lambda spark, sf: fn(scored_layer(spark, sf))


#: Idioms of the adapter's phrases: some begin alike, hold lexicon or rule words, or stand beside them.
IDIOMS = [("waste of money", -2.0), ("total waste of money", -3.4), ("nothing special", -0.9), ("not good", -1.2), ("full of bugs", -2.4), ("great if they", 0.1),
          ("losing money", -2.6), ("slow and full", -1.0), ("low fees", 1.1), ("did not help", -1.7), ("too high", -1.6)]


def _idioms_sql() -> str:
    second = scoring_ctes("clean1", "scored_i", IDIOMS)
    for name in ["lex", "toks", "tk", "tv2", "tv", "tsum", "pol3", "pol2", "pol", "lane"]:
        second = re.sub(rf"\b{name}\b", f"idi_{name}", second)
    return with_base(f", {second}\nSELECT product, review_id, sentiment_raw FROM scored_i")


QUERIES = {
    "c1_unify": (
        _c1,
        f"""SELECT platform, count(*) AS n, count(rating) AS rated FROM (
  SELECT review_id, platform, date, rating, review_text FROM ({with_base('SELECT * FROM reviews')})
  UNION ALL BY NAME {CONV_SQL}) GROUP BY platform""",
    ),
    "c2_clean_text": (
        lambda spark, sf: _padded(spark, sf).select("doc_id", clean_text("raw").alias("text"),
                                                    F.length(clean_text("raw")).alias("n_chars")),
        f"SELECT doc_id, {trim_sql('raw')} AS text, length({trim_sql('raw')}) AS n_chars FROM ({PADDED_SQL})",
    ),
    "c3_clean_date": (
        lambda spark, sf: _dates(spark, sf).select("doc_id", "raw_date", clean_date("raw_date").alias("date")),
        f"SELECT doc_id, raw_date, TRY_CAST(raw_date AS DATE) AS date FROM ({DATES_SQL})",
    ),
    "c4_min_length": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", clean_text("text").alias("t"))
        .filter(F.length("t") > FV.MIN_TEXT_LEN_INGEST).select("doc_id", F.length("t").alias("n_chars")),
        f"SELECT doc_id, length({trim_sql('text')}) AS n_chars FROM documents WHERE length({trim_sql('text')}) > {FV.MIN_TEXT_LEN_INGEST}",
    ),
    "c5_dedup_first": (
        lambda spark, sf: clean_layer(spark, sf).select("product", "review_id", F.length("review_text").alias("n_chars")),
        with_base("SELECT product, review_id, length(review_text) AS n_chars FROM clean"),
    ),
    "c6_platform_counts": (
        lambda spark, sf: C.platform_counts(clean_layer(spark, sf)),
        with_base("SELECT product, platform, count(*) AS n FROM clean GROUP BY ALL"),
    ),
    "c7_clean_rating": (
        lambda spark, sf: _ratings(spark, sf).select("doc_id", "raw_rating", clean_rating("raw_rating").alias("rating")),
        f"SELECT doc_id, raw_rating, TRY_CAST(raw_rating AS DOUBLE) AS rating FROM ({RATINGS_SQL})",
    ),
    "c8_with_seq": (
        lambda spark, sf: C.with_seq(clean_layer(spark, sf), ["product", "review_id"], group=["product"])
        .select("product", "review_id", "review_seq"),
        with_base("SELECT product, review_id, row_number() OVER (PARTITION BY product ORDER BY review_id) AS review_seq FROM clean"),
    ),
    "c9_sample_n": (
        lambda spark, sf: C.sample_n(clean_layer(spark, sf), 50, seed=7).select("product", "review_id"),
        with_base("SELECT product, review_id FROM clean ORDER BY md5('7:' || CAST(review_id AS VARCHAR)), review_id LIMIT 50"),
    ),
    "d1_rating_sentiment": (
        lambda spark, sf: clean_layer(spark, sf).filter(F.col("rating").isNotNull()).select(
            "product", "review_id", *[c.alias(n) for c, n in zip(D.rating_sentiment(F.col("rating")), ["sentiment", "sentiment_score"])]),
        with_base("SELECT product, review_id, sentiment, sentiment_score FROM scored WHERE rating IS NOT NULL"),
    ),
    "d2_lexicon_polarity": (
        lambda spark, sf: D.lexicon_polarity(clean_layer(spark, sf), D.lexicon_table(spark)).select("product", "review_id", "sentiment_raw"),
        with_base("SELECT product, review_id, sentiment_raw FROM scored"),
    ),
    "d2_idioms": (
        lambda spark, sf: D.lexicon_polarity(clean_layer(spark, sf), D.lexicon_table(spark), idioms=spark.createDataFrame(IDIOMS, "idiom string, valence double"))
        .select("product", "review_id", "sentiment_raw"),
        _idioms_sql(),
    ),
    "d3_success_correction": (
        _q(lambda r: r.filter(F.col("rating").isNull() & (F.col("sentiment_raw") < -FV.LABEL_THRESHOLD)
                              & D.success_story(F.lower("review_text")))
           .select("product", "review_id", "sentiment", "sentiment_score")),
        with_base(f"""SELECT product, review_id, sentiment, sentiment_score FROM scored
WHERE rating IS NULL AND sentiment_raw < -{FV.LABEL_THRESHOLD}
  AND {rx('lower(review_text)', FV.SUCCESS_STORY_PATTERN)} AND NOT {rx('lower(review_text)', FV.PRODUCT_COMPLAINT_PATTERN)}"""),
    ),
    "d4_label": (
        _q(lambda r: r.select("product", "review_id", label("sentiment_raw").alias("lexicon_label"))),
        with_base("SELECT product, review_id, CASE WHEN sentiment_raw >= 0.05 THEN 'Positive' WHEN sentiment_raw <= -0.05 "
                  "THEN 'Negative' ELSE 'Neutral' END AS lexicon_label FROM scored"),
    ),
    "d5_sentiment_audit": (
        _q(D.sentiment_audit),
        with_base("SELECT product, review_id, sentiment, sentiment_score, sentiment_raw, sentiment_corrected FROM scored"),
    ),
    "d6_label_to_score": (
        lambda spark, sf: table(spark, sf, "labels").select(
            "doc_id", F.when(F.col("toxic") == 1, "NEGATIVE").when(F.col("quality") == 1, "positive").alias("llm_label")
        ).select("doc_id", "llm_label", label_to_score("llm_label").alias("score")),
        """SELECT doc_id, llm_label, CASE WHEN lower(llm_label) = 'positive' THEN 0.5 WHEN lower(llm_label) = 'negative' THEN -0.5
ELSE 0.0 END AS score FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 'NEGATIVE' WHEN quality = 1 THEN 'positive' END AS llm_label FROM labels)""",
    ),
    "d7_score_sentiment": (_d7, _d7_sql()),
    "d7_without_lexicon": (
        lambda spark, sf: D.score_sentiment(clean_layer(spark, sf).join(llm_labels(spark, sf), "review_id", "left"), products(spark), use_lexicon=False)
        .select("product", "review_id", "sentiment_lane", "sentiment", "sentiment_score"),
        with_base(f"""
, j AS (SELECT s.*, l.llm_sentiment FROM clean s LEFT JOIN ({LLM_SQL}) l ON l.review_id = s.review_id),
fl AS (SELECT product, (({" OR ".join(f"product = {sql_str(p)}" for p, _, _, u in FV.PRODUCTS if u) or "FALSE"}) AND bool_or(llm_sentiment IS NOT NULL)) AS llm FROM j GROUP BY product)
SELECT j.product, review_id, CASE WHEN fl.llm THEN 'llm' ELSE 'none' END AS sentiment_lane,
       CASE WHEN fl.llm THEN llm_sentiment ELSE 'Unknown' END AS sentiment,
       CASE WHEN fl.llm AND lower(llm_sentiment) = 'positive' THEN 0.5 WHEN fl.llm AND lower(llm_sentiment) = 'negative' THEN -0.5
            ELSE 0.0 END AS sentiment_score
FROM j JOIN fl ON fl.product = j.product"""),
    ),
    "e1_taxonomy": (
        lambda spark, sf: clean_layer(spark, sf).select("product_type").distinct().join(E.taxonomy(spark), "product_type"),
        with_base("SELECT DISTINCT c.product_type, t.theme, t.ord, t.pattern FROM clean c JOIN (VALUES "
                  + ", ".join(f"({sql_str(pt)}, {sql_str(th)}, {i + 1}, {sql_str(p)})"
                              for pt, lst in FV.THEME_PATTERNS.items() for i, (th, p) in enumerate(lst))
                  + ") t(product_type, theme, ord, pattern) ON t.product_type = c.product_type"),
    ),
    "e2_tag_themes": (
        _q(lambda r: E.review_theme(r)),
        with_base("SELECT product, review_id, theme FROM review_theme"),
    ),
    "e2_tag_themes_stem": (
        lambda spark, sf: E.review_theme(E.tag_themes(clean_layer(spark, sf), stem=True)),
        with_base(f"SELECT product, review_id, unnest(list_filter([{_stem_sql_hits()}], lambda x: x IS NOT NULL)) AS theme FROM clean"),
    ),
    "e3_parse_themes": (_e3, E3_SQL),
    "e4_themes_wide": (
        _q(lambda r: E.themes_wide(r).select("product", "review_id", *[f"theme_{t}" for t in ALL_THEMES])),
        with_base("SELECT product, review_id, "
                  + ", ".join(f"list_contains(themes, {sql_str(t)}) AS \"theme_{t}\"" for t in ALL_THEMES) + " FROM scored"),
    ),
}

