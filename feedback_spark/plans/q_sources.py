"""Registered queries B1-B7 (Spark plan + DuckDB oracle SQL).

Landed payloads are derived from the driver tables: Play Store and App Store
records from ``documents``, Reddit listings and tweets from
``conversations``, Trustpilot and map-review pages rendered from
``documents`` as HTML (escaped), plus the raw ``pages`` table.  Each oracle
computes the expected review rows straight from the source columns, so the
JSON and HTML parsing in Spark is checked end to end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedback_spark.functions.text import clean_text
from feedback_spark.operators.clean import carry_forward
from feedback_spark.plans.sql_base import trim_sql, with_base
from feedback_spark.sources import payloads as B
from feedback_spark.sources.testdata import reviews, table



def _date():
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(700)).cast("int"))


DATE_SQL = "CAST(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER) AS DATE)"


def _esc(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _playstore_raw(spark, sf):
    d = table(spark, sf, "documents")
    rec = F.struct(F.concat(F.date_format(_date(), "yyyy-MM-dd"), F.lit("T12:30:00")).alias("at"),
                   F.concat(F.lit("user_"), F.pmod("doc_id", F.lit(50)).cast("string")).alias("userName"),
                   F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit(None)).otherwise(F.pmod("doc_id", F.lit(5)) + 1).cast("double").alias("score"),
                   F.col("text").alias("content"))
    return d.select(F.to_json(rec).alias("payload"))


def _app_store_raw(spark, sf):
    d = table(spark, sf, "documents")
    date = F.when(F.pmod("doc_id", F.lit(4)) == 0, F.lit("last week")).otherwise(
        F.concat(F.date_format(_date(), "yyyy-MM-dd"), F.lit(" 08:15:00")))
    rec = F.struct(date.alias("date"), F.concat(F.lit("user_"), F.pmod("doc_id", F.lit(50)).cast("string")).alias("userName"),
                   (F.pmod("doc_id", F.lit(5)) + 1).cast("double").alias("rating"), F.col("text").alias("review"))
    return d.select(F.to_json(rec).alias("payload"))


def _reddit_raw(spark, sf):
    c = table(spark, sf, "conversations")
    post = F.struct(
        F.when(F.pmod("turn", F.lit(3)) == 0, F.col("text")).otherwise(F.substring("text", 1, 40)).alias("title"),
        F.when(F.pmod("turn", F.lit(3)) == 0, F.lit("")).otherwise(F.col("text")).alias("selftext"),
        (F.lit(1700000000) + F.col("conv_id") * 86400 + F.col("turn") * 60).cast("double").alias("created_utc"),
        F.col("role").alias("author"),
        F.concat(F.lit("/r/reviews/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("permalink"))
    # one listing per conversation; a conversation's turns are a bounded group
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", post.alias("data")))).alias("ch"))
    listing = F.struct(F.struct(F.transform("ch", lambda x: F.struct(x["data"].alias("data"))).alias("children")).alias("data"))
    return g.select(F.col("conv_id").alias("seq"), F.to_json(listing).alias("payload"))


def _twitter_raw(spark, sf):
    c = table(spark, sf, "conversations")
    rec = F.struct(F.col("text"), F.concat(F.lit("2024-02-"), F.lpad((F.pmod("conv_id", F.lit(28)) + 1).cast("string"), 2, "0"),
                                           F.lit("T09:00:00")).alias("timestamp"),
                   F.struct(F.col("role").alias("screen_name")).alias("user"),
                   F.concat(F.lit("https://x.example/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("tweet_url"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.to_json(rec).alias("payload"))


def _pages(spark, sf, kind):
    d = table(spark, sf, "documents")
    title = F.substring("text", 1, 24)
    if kind == "trustpilot":
        rating = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("")).otherwise(F.concat(
            F.lit('<div data-service-review-rating="'),
            F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit("x")).otherwise((F.pmod("doc_id", F.lit(5)) + 1).cast("string")),
            F.lit('"></div>')))
        card = F.concat(
            F.lit('<article data-service-review-card-paper="true"><h2 data-service-review-title-typography="true">'), _esc(title),
            F.lit('<br></h2><img src="a.png" alt="">'), rating, F.lit('<input type="hidden"><p data-service-review-text-typography="true">'), _esc(F.col("text")), F.lit("<br></p>"),
            F.lit('<p>unclosed<div class="x"><hr><time datetime="'), F.date_format(_date(), "yyyy-MM-dd"), F.lit('T10:00:00.000Z"></time>'),
            F.lit('<aside aria-label="Info for user_'), F.pmod("doc_id", F.lit(50)).cast("string"), F.lit('"></aside></div></article>'))
    else:
        card = F.concat(
            F.lit('<div data-review-id="'), F.col("doc_id").cast("string"), F.lit('"><div class="d4r55">user_'),
            F.pmod("doc_id", F.lit(50)).cast("string"), F.lit("</div>"),
            F.when(F.pmod("doc_id", F.lit(4)) == 0, F.lit("")).otherwise(F.concat(
                F.lit('<span aria-label="'), (F.pmod("doc_id", F.lit(5)) + 1).cast("string"), F.lit(' stars"></span>'))),
            F.lit('<span class="rsqaWe">'), (F.pmod("doc_id", F.lit(9)) + 1).cast("string"), F.lit(" weeks ago</span>"),
            F.lit('<img src="a.png"><br><span class="wiI7pd">'), _esc(F.col("text")), F.lit("<br></span></div>"))
    # ten cards per page: a bounded group
    pages = d.groupBy(F.floor(F.col("doc_id") / 10).alias("page_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", card.alias("c")))), lambda x: x["c"]), "").alias("cards"))
    return pages.select("page_id", F.concat(F.lit("https://reviews.example/page/"), F.col("page_id").cast("string")).alias("url"),
                        F.concat(F.lit("<html><body><main>"), F.col("cards"), F.lit("</main></body></html>")).alias("html"))


def _carded_pages(spark, sf):
    """The raw web pages, each with one review card (and void elements) before its own markup."""
    card = F.concat(F.lit('<article data-service-review-card-paper="1"><img src="a.png"><h2 data-service-review-title-typography="1">Page '), F.col("page_id").cast("string"),
                    F.lit('</h2><br><div data-service-review-rating="'), (F.pmod("page_id", F.lit(5)) + 1).cast("string"),
                    F.lit('"></div><p data-service-review-text-typography="1">seen<br></p></article>'))
    return table(spark, sf, "pages").select("page_id", "url", F.concat(card, F.coalesce("html", F.lit(""))).alias("html"))


def _b7(spark, sf):
    prev = reviews(spark, sf).select("platform", "review_id", "review_text")
    new = (reviews(spark, sf).filter(F.col("platform").isin("reddit", "twitter"))
           .select("platform", (F.col("review_id") + 10**9).alias("review_id"), "review_text"))
    return carry_forward(prev, new).groupBy("platform").agg(F.count("*").alias("n"), F.max("review_id").alias("max_id"))


def _tp_sql() -> str:
    t = trim_sql
    return f"""SELECT 'trustpilot' AS platform, strftime({DATE_SQL}, '%Y-%m-%d') AS date, 'user_' || CAST(doc_id % 50 AS VARCHAR) AS author,
  CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating,
  {t(t('substr(text, 1, 24)') + " || ' ' || " + t('text'))} AS review_text,
  'https://reviews.example/page/' || CAST(doc_id // 10 AS VARCHAR) AS source_url
FROM documents"""


def _maps_sql() -> str:
    return f"""SELECT platform, date, author, rating, review_text, source_url FROM (
  SELECT doc_id, 'google_maps' AS platform, CAST(doc_id % 9 + 1 AS VARCHAR) || ' weeks ago' AS date,
         'user_' || CAST(doc_id % 50 AS VARCHAR) AS author,
         CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating,
         {trim_sql('text')} AS review_text, 'https://reviews.example/page/' || CAST(doc_id // 10 AS VARCHAR) AS source_url
  FROM documents WHERE length({trim_sql('text')}) >= 10)
QUALIFY row_number() OVER (PARTITION BY review_text ORDER BY doc_id) = 1"""


REDDIT_SQL = f"""SELECT platform, date, author, rating, review_text, source_url FROM (
  SELECT conv_id, turn, 'reddit' AS platform,
         strftime(make_timestamp(CAST((1700000000 + conv_id * 86400 + turn * 60) * 1000000 AS BIGINT)), '%Y-%m-%d') AS date,
         role AS author, CAST(NULL AS DOUBLE) AS rating,
         {trim_sql("CASE WHEN turn % 3 = 0 THEN text ELSE substr(text, 1, 40) || ' ' || text END")} AS review_text,
         'https://reddit.com/r/reviews/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS source_url
  FROM conversations
  WHERE length({trim_sql("text")}) >= 20)
QUALIFY row_number() OVER (PARTITION BY review_text ORDER BY conv_id, turn) = 1"""

TWITTER_SQL = f"""SELECT platform, date, author, rating, review_text, source_url FROM (
  SELECT conv_id, turn, 'twitter' AS platform, '2024-02-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') AS date,
         role AS author, CAST(NULL AS DOUBLE) AS rating, {trim_sql('text')} AS review_text,
         'https://x.example/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS source_url
  FROM conversations WHERE length({trim_sql('text')}) >= 20)
QUALIFY row_number() OVER (PARTITION BY review_text ORDER BY conv_id * 1000 + turn) = 1"""

def _ingest(spark, sf):
    from feedback_spark.operators.clean import ingest, platform_counts

    # collector order of a run: Play Store, Reddit, Trustpilot, Maps, App Store, Twitter
    srcs = [QUERIES[k][0](spark, sf) for k in ("b1_from_playstore", "b2_from_reddit", "b3_from_trustpilot_html",
                                                 "b5_from_maps_html", "b6_from_app_store", "b4_from_twitter")]
    r = ingest(srcs)
    return platform_counts(r.withColumn("product", F.lit("all"))).join(
        r.groupBy("platform").agg(F.count("date").alias("dated"), F.count("rating").alias("rated")), "platform")


def _ingest_sql() -> str:
    parts = [QUERIES[k][1] for k in ("b1_from_playstore", "b2_from_reddit", "b3_from_trustpilot_html",
                                     "b5_from_maps_html", "b6_from_app_store", "b4_from_twitter")]
    union = "\nUNION ALL\n".join(f"SELECT *, {i} AS source_rank FROM ({p})" for i, p in enumerate(parts))
    t = trim_sql("review_text")
    return f"""WITH u AS ({union}),
c AS (SELECT platform, TRY_CAST(date AS DATE) AS date, author, TRY_CAST(CAST(rating AS VARCHAR) AS DOUBLE) AS rating,
             {t} AS review_text, source_url, source_rank FROM u WHERE length({t}) > 20),
d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY review_text
                           ORDER BY source_rank, date NULLS FIRST, author NULLS FIRST, rating NULLS FIRST, source_url NULLS FIRST) = 1)
SELECT 'all' AS product, platform, count(*) AS n, count(date) AS dated, count(rating) AS rated FROM d GROUP BY platform"""


QUERIES = {
    "b1_from_playstore": (
        lambda spark, sf: B.from_playstore(_playstore_raw(spark, sf), "com.example.app", "customer"),
        f"""SELECT 'playstore_customer' AS platform, strftime({DATE_SQL}, '%Y-%m-%d') AS date,
  'user_' || CAST(doc_id % 50 AS VARCHAR) AS author,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating, text AS review_text,
  'https://play.google.com/store/apps/details?id=com.example.app' AS source_url FROM documents""",
    ),
    "b2_from_reddit": (lambda spark, sf: B.from_reddit(_reddit_raw(spark, sf)), REDDIT_SQL),
    "b3_from_trustpilot_html": (
        lambda spark, sf: B.from_trustpilot_html(_pages(spark, sf, "trustpilot")).drop("page_id", "card"),
        _tp_sql(),
    ),
    "b3_raw_pages": (
        lambda spark, sf: B.from_trustpilot_html(_carded_pages(spark, sf)).drop("card"),
        """SELECT page_id, 'trustpilot' AS platform, '' AS date, '' AS author, CAST(page_id % 5 + 1 AS DOUBLE) AS rating,
  'Page ' || CAST(page_id AS VARCHAR) || ' seen' AS review_text, url AS source_url FROM pages""",
    ),
    "b4_from_twitter": (lambda spark, sf: B.from_twitter(_twitter_raw(spark, sf)), TWITTER_SQL),
    "b5_from_maps_html": (
        lambda spark, sf: B.from_maps_html(_pages(spark, sf, "google_maps")).select(
            "platform", "date", "author", "rating", clean_text("review_text").alias("review_text"), "source_url"),
        _maps_sql(),
    ),
    "b6_from_app_store": (
        lambda spark, sf: B.from_app_store(_app_store_raw(spark, sf), "in", "example-app", "123"),
        f"""SELECT 'app_store' AS platform,
  CASE WHEN doc_id % 4 = 0 THEN 'last week' ELSE strftime({DATE_SQL}, '%Y-%m-%d') END AS date,
  'user_' || CAST(doc_id % 50 AS VARCHAR) AS author, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating, text AS review_text,
  'https://apps.apple.com/in/app/example-app/id123' AS source_url FROM documents""",
    ),
    "b7_carry_forward": (
        _b7,
        with_base("""
SELECT platform, count(*) AS n, max(review_id) AS max_id FROM (
  SELECT platform, review_id FROM reviews WHERE platform NOT IN ('reddit', 'twitter')
  UNION ALL SELECT platform, review_id + 1000000000 FROM reviews WHERE platform IN ('reddit', 'twitter'))
GROUP BY platform"""),
    ),
}
QUERIES["c1_ingest_all"] = (_ingest, _ingest_sql())
