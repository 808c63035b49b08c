"""B: landed payloads -> unified review rows.

Network collection is not data work; these adapters start from payloads that
have already landed as JSON text (one record or listing per row) or HTML
pages, and shape them into the six-column unified review.  JSON records are
parsed with ``from_json`` against a fixed schema (no inference); HTML pages
are parsed per page inside ``mapInPandas`` with the standard-library HTML
parser (:mod:`feedback_spark.sources.html`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.functions.text import clean_text
from feedback_spark.operators.clean import dedup_first

REVIEW_SCHEMA = "platform string, date string, author string, rating double, review_text string, source_url string"


def from_playstore(raw: DataFrame, app_id: str, label: str, col: str = "payload") -> DataFrame:
    """B1: {at, userName, score, content} records."""
    r = F.from_json(col, "struct<at:string,userName:string,score:double,content:string>")
    x = raw.select(r.alias("r"))
    at = F.col("r.at")
    date = F.coalesce(F.date_format(F.try_to_timestamp(at), "yyyy-MM-dd"), at)
    return x.select(
        F.lit(f"playstore_{label}").alias("platform"), date.alias("date"),
        F.coalesce("r.userName", F.lit("")).alias("author"), F.col("r.score").alias("rating"),
        F.coalesce("r.content", F.lit("")).alias("review_text"),
        F.lit(f"https://play.google.com/store/apps/details?id={app_id}").alias("source_url"),
    )


def from_reddit(raw: DataFrame, col: str = "payload", key: str = "seq") -> DataFrame:
    """B2: listing JSON -> one row per post with usable text; dedup by text.

    Guard text is selftext, or the title when selftext is empty; posts whose
    trimmed guard text is under 20 characters are dropped.  The review text is
    title + " " + selftext, trimmed; the date is the UTC day of created_utc.
    """
    post = "struct<title:string,selftext:string,created_utc:double,author:string,permalink:string>"
    listing = F.from_json(col, f"struct<data:struct<children:array<struct<data:{post}>>>>")
    x = raw.select(F.col(key), F.posexplode(listing["data"]["children"]).alias("i", "c")).select(key, "i", "c.data.*")
    guard = F.coalesce(F.nullif(F.coalesce("selftext", F.lit("")), F.lit("")), F.coalesce("title", F.lit("")))
    x = x.filter(F.length(clean_text(guard)) >= 20)
    out = x.select(
        key, "i", F.lit("reddit").alias("platform"),
        # UTC day by arithmetic, independent of the session time zone
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"),
                                 F.floor(F.coalesce("created_utc", F.lit(0.0)) / 86400).cast("int")), "yyyy-MM-dd").alias("date"),
        F.coalesce("author", F.lit("")).alias("author"), F.lit(None).cast("double").alias("rating"),
        clean_text(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("selftext", F.lit("")))).alias("review_text"),
        F.concat(F.lit("https://reddit.com"), F.coalesce("permalink", F.lit(""))).alias("source_url"),
    )
    return dedup_first(out, ["review_text"], [key, "i"]).drop(key, "i")


def from_twitter(raw: DataFrame, col: str = "payload", key: str = "seq") -> DataFrame:
    """{text, timestamp, user:{screen_name}, tweet_url}; drop trimmed text < 20; dedup."""
    t = F.from_json(col, "struct<text:string,timestamp:string,user:struct<screen_name:string>,tweet_url:string>")
    x = raw.select(key, t.alias("t"))
    text = clean_text(F.coalesce("t.text", F.lit("")))
    out = x.filter(F.length(text) >= 20).select(
        key, F.lit(0).alias("i"), F.lit("twitter").alias("platform"),
        F.substring(F.coalesce("t.timestamp", F.lit("")), 1, 10).alias("date"),
        F.coalesce("t.user.screen_name", F.lit("")).alias("author"), F.lit(None).cast("double").alias("rating"),
        text.alias("review_text"), F.coalesce("t.tweet_url", F.lit("")).alias("source_url"),
    )
    return dedup_first(out, ["review_text"], [key, "i"]).drop(key, "i")


def from_app_store(raw: DataFrame, country: str, app_name: str, app_id: str, col: str = "payload") -> DataFrame:
    """{date, userName, rating, review}; date formatted when it parses, else its first 10 chars."""
    r = F.from_json(col, "struct<date:string,userName:string,rating:double,review:string>")
    x = raw.select(r.alias("r"))
    d = F.col("r.date")
    date = F.coalesce(F.date_format(F.try_to_timestamp(d), "yyyy-MM-dd"), F.substring(F.coalesce(d, F.lit("")), 1, 10))
    return x.select(
        F.lit("app_store").alias("platform"), date.alias("date"), F.coalesce("r.userName", F.lit("")).alias("author"),
        F.col("r.rating").alias("rating"), F.coalesce("r.review", F.lit("")).alias("review_text"),
        F.lit(f"https://apps.apple.com/{country}/app/{app_name}/id{app_id}").alias("source_url"),
    )


def from_trustpilot_html(pages: DataFrame, url_col: str = "url", html_col: str = "html", key: str = "page_id") -> DataFrame:
    """Review cards of landed pages -> rows (0..n per page)."""
    from feedback_spark.sources.html import parse_pages

    return parse_pages(pages, "trustpilot", url_col, html_col, key)


def from_maps_html(pages: DataFrame, url_col: str = "url", html_col: str = "html", key: str = "page_id") -> DataFrame:
    """Map-review containers of landed pages -> rows; text < 10 dropped; dedup by text."""
    from feedback_spark.sources.html import parse_pages

    out = parse_pages(pages, "google_maps", url_col, html_col, key)
    return dedup_first(out, ["review_text"], [key, "card"])
