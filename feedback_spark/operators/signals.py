"""G: feature requests, churn sentences, competitor mentions, opportunity gaps.

Sentence rules split each review into sentences with ``posexplode(split)``
(narrow), test them with ``rlike`` and count identical snippets with a
partially aggregated ``groupBy``; the top-k keeps the first appearance
(review order, then sentence position) as the tie-break.  Competitor
patterns are one projection (like theme tagging) followed by ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import portable
from feedback_spark.functions.text import clean_text
from feedback_spark.functions.topk import top_k

P = "product"


def _sentences(r: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return r.select(P, "review_id", *keep, F.posexplode(F.split(F.col("review_text"), FV.SENTENCE_SPLIT)).alias("pos", "raw"))


def _count_snippets(x: DataFrame, n: int) -> DataFrame:
    agg = x.groupBy(P, "snippet").agg(F.count("*").alias("n"), F.min(F.struct("review_id", "pos")).alias("first"))
    top = top_k(agg, [P], [F.desc("n"), F.col("first")], n)
    return top.select(P, "rank", "snippet", "n", F.col("first.review_id").alias("first_review_id"))


def feature_requests(r: DataFrame, n: int = 6) -> DataFrame:
    """G1: request sentences from Negative / Neutral reviews, counted, top n."""
    s = _sentences(r.filter(F.col("sentiment").isin("Negative", "Neutral")))
    s = s.withColumn("s", clean_text("raw"))
    lc = F.lower("s")
    ok = (lc.rlike(portable(FV.FEATURE_REQUEST_PATTERN)) & ~lc.rlike(portable(FV.REQUEST_SUPPRESS_PATTERN))
          & (F.length("s") > FV.REQUEST_MIN_LEN) & (F.length("s") < FV.REQUEST_MAX_LEN))
    return _count_snippets(s.filter(ok).withColumn("snippet", F.substring("s", 1, FV.SNIPPET_CHARS)), n)


def churn_sentences(r: DataFrame, n: int = 4) -> DataFrame:
    """Churn sentences (any sentiment) from reviews that match, counted, top n."""
    pat = portable(FV.CHURN_PATTERN)
    s = _sentences(r.filter(F.lower("review_text").rlike(pat)))
    s = s.withColumn("s", clean_text("raw"))
    ok = F.lower("raw").rlike(pat) & (F.length("s") > FV.CHURN_MIN_LEN)
    return _count_snippets(s.filter(ok).withColumn("snippet", F.substring("s", 1, FV.SNIPPET_CHARS)), n)


def _flag_snippet(primary: str, strict: bool) -> Column:
    text120 = F.substring("review_text", 1, FV.SNIPPET_CHARS)
    a, si = F.col(primary), F.col("specific_issue")
    if strict:
        # original behaviour after a CSV read: a missing value is truthy, so
        # specific_issue is only reached when the primary field is an empty string
        return F.when(a.isNull(), text120).when(a == "", F.coalesce(F.nullif(si, F.lit("")), text120)).otherwise(a)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(si, F.lit("")), text120)


def flagged(r: DataFrame, flag: str, primary: str, n: int, strict: bool = False) -> DataFrame:
    """First n flagged rows in review order with their snippet."""
    x = r.filter(F.col(flag) == F.lit(True)).select(P, "review_id", _flag_snippet(primary, strict).alias("snippet"))
    return top_k(x, [P], [F.col("review_id")], n).withColumn("n", F.lit(1).cast("long"))


def flagged_requests(r: DataFrame, n: int = 6, strict: bool = False) -> DataFrame:
    return flagged(r, "is_feature_request", "action_item", n, strict)


def flagged_churn(r: DataFrame, n: int = 4, strict: bool = False) -> DataFrame:
    return flagged(r, "is_churn_signal", "churn_reason", n, strict)


def competitor_mentions(r: DataFrame, patterns: dict | None = None) -> DataFrame:
    """Reviews matching each competitor pattern of the product's type; self excluded."""
    patterns = patterns or FV.COMPETITOR_PATTERNS
    lc = F.lower("review_text")
    hits = F.filter(F.array(*[
        F.when((F.col("product_type") == pt) & lc.rlike(portable(p)), F.struct(F.lit(name).alias("name"), F.lit(i + 1).alias("ord")))
        for pt, lst in patterns.items() for i, (name, p) in enumerate(lst)
    ]), lambda x: x.isNotNull())
    x = r.select(P, F.explode(hits).alias("c")).filter(F.lower(F.col("c.name")) != F.lower(F.col(P)))
    return x.groupBy(P, F.col("c.name").alias("competitor"), F.col("c.ord").alias("ord")).agg(F.count("*").alias("mentions"))


def competitor_context(r: DataFrame, mentions: DataFrame, n: int = 7, patterns: dict | None = None) -> DataFrame:
    """Top n competitors with sentiment counts of reviews containing the literal name."""
    patterns = patterns or FV.COMPETITOR_PATTERNS
    top = top_k(mentions, [P], [F.desc("mentions"), F.col("ord")], n)
    lc = F.lower("review_text")
    lit_hits = F.filter(F.array(*[
        F.when((F.col("product_type") == pt) & lc.contains(name.lower()), F.lit(name))
        for pt, lst in patterns.items() for name, _ in lst
    ]), lambda x: x.isNotNull())
    ctx = (r.select(P, "sentiment", F.explode(lit_hits).alias("competitor"))
           .groupBy(P, "competitor").agg(F.sum(F.when(F.col("sentiment") == "Positive", 1).otherwise(0)).cast("long").alias("pos"),
                                         F.sum(F.when(F.col("sentiment") == "Negative", 1).otherwise(0)).cast("long").alias("neg")))
    out = top.join(ctx, [P, "competitor"], "left").na.fill(0, ["pos", "neg"])
    mx = F.max("mentions").over(Window.partitionBy(P))  # small result: <= n rows per product
    badge = F.when(F.col("pos") > F.col("neg"), "praised").when(F.col("neg") > F.col("pos"), "criticised").otherwise("neutral")
    return out.select(P, "rank", "competitor", "mentions", "pos", "neg", badge.alias("badge"),
                      F.floor(F.col("mentions") / mx * 100).cast("long").alias("share"))


def opportunity_gaps(weak: DataFrame, neg_phrases: DataFrame, requests: DataFrame, mentions: DataFrame,
                     n: int = 5) -> DataFrame:
    """<= 3 weaknesses (with a negative-phrase hint), <= 2 requests, the top competitor; first n."""
    w = (weak.filter(F.col("kind") == "weakness").filter(F.col("rank") <= 3)
         .join(neg_phrases.filter(F.col("rank") == 1).select(P, "theme", F.col("phrase")), [P, "theme"], "left")
         .select(P, F.lit(1).alias("kind_rank"), "rank", F.lit("weakness").alias("kind"), F.col("theme").alias("item"),
                 F.col("negative").alias("count"), F.substring("phrase", 1, 60).alias("hint")))
    q = (requests.filter(F.col("rank") <= 2)
         .select(P, F.lit(2).alias("kind_rank"), "rank", F.lit("request").alias("kind"),
                 F.substring("snippet", 1, 80).alias("item"), F.col("n").alias("count"), F.lit(None).cast("string").alias("hint")))
    c = (top_k(mentions, [P], [F.desc("mentions"), F.col("ord")], 1)
         .select(P, F.lit(3).alias("kind_rank"), "rank", F.lit("competitor").alias("kind"), F.col("competitor").alias("item"),
                 F.col("mentions").alias("count"), F.lit(None).cast("string").alias("hint")))
    u = w.unionByName(q).unionByName(c)
    ranked = u.withColumn("gap", F.row_number().over(Window.partitionBy(P).orderBy("kind_rank", "rank")).cast("long"))
    return ranked.filter(F.col("gap") <= n).select(P, "gap", "kind", "item", F.col("count").cast("long").alias("count"), "hint")
