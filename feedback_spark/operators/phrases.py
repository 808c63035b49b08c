"""F: TF-IDF phrase mining, grouped.

``top_phrases`` computes, for every group at once, the summed L2-normalised
TF-IDF weight of each n-gram and keeps the top ``n`` (smoothed idf
``ln((1+N)/(1+df)) + 1``, minimum document frequency, stop words removed
before n-grams are formed).

Physical plan, chosen for skew and disk:

1. the texts are cut once into blocks of token codes; terms, as digests of their
   group and tokens, are counted in passes over these blocks (``term_sums``), each
   of which drops its shuffle files, so the disk holds the blocks and one pass;
2. a pass returns what its known terms add to the documents' norms; with the
   norms known, the passes run again and each task keeps its best terms;
3. only the best terms get their names, from a second cutting of the texts.

A vocabulary cut by name (``cap``) needs the terms as texts: ``term_counts``
cuts a text into n-grams in place, one row carries an n-gram and the token
after it (two lengths at once), and one sort in the partition of its group and
n-gram serves both counts.

Groups with fewer than ``min_docs`` texts use the word-count fallback (F2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import PHRASE_TOKEN, SPACE
from feedback_spark.functions.topk import top_k
from feedback_spark.operators.term_sums import best_terms
from feedback_spark.session import persisted

TEXT = "review_text"
DOC = "review_id"


def phrase_tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-cased Unicode word tokens of 2+ chars, stop words removed, order kept."""
    stops = list(stop_words if stop_words is not None else FV.ENGLISH_STOP_WORDS)
    toks = F.regexp_extract_all(F.lower(text), F.lit(PHRASE_TOKEN), 0)
    # a literal IN list becomes a hash-set lookup (InSet) inside the lambda
    return F.filter(toks, lambda t: ~t.isin(stops))


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams (lo..hi) of a token array, space-joined, grouped by n, in order.

    Built from shifted slices with ``zip_with`` (linear in the array length);
    ``tokens`` should be a column reference, not an expression, so it is
    evaluated once per row.
    """
    size = F.size(tokens)
    empty = F.array().cast("array<string>")
    by_n = {1: tokens}
    for n in range(2, hi + 1):
        prev = F.slice(by_n[n - 1], 1, size - n + 1)
        by_n[n] = F.zip_with(prev, F.slice(tokens, n, size - n + 1), lambda a, b: F.concat(a, F.lit(" "), b))
    # guard short arrays (slice lengths must not go negative)
    parts = [F.when(size >= n, by_n[n]).otherwise(empty) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def gram_rows(docs: DataFrame, keys: list[str], ngram_range: tuple[int, int], text: str = TEXT) -> DataFrame:
    """(keys, head, rest): what every n-gram of a text can be read from, one row for two lengths.

    A row holds an n-gram and the token after it, thus the (n+1)-gram too; a
    single length, the 1-grams always, has rows without a rest.
    """
    lo, hi = ngram_range
    toks = docs.select(*keys, phrase_tokens(F.col(text)).alias("_toks"))
    none, parts, n = F.array().cast("array<string>"), [], hi
    while n >= lo:
        paired = n - 1 >= max(lo, 2)
        n -= paired
        rest = F.when(F.size("_toks") > n, F.slice("_toks", n + 1, F.greatest(F.size("_toks") - n, F.lit(1)))).otherwise(none) if paired else none
        parts.append(F.arrays_zip(ngrams(F.col("_toks"), n, n).alias("head"), rest.alias("rest")))
        n -= 1
    zipped = "array<struct<head:string,rest:string>>"
    return toks.select(*keys, F.inline(F.concat(*[x.cast(zipped) for x in parts])))


def term_counts(docs: DataFrame, group: list[str], ngram_range: tuple[int, int], text: str = TEXT, doc: str = DOC,
                partitions: int | None = None) -> DataFrame:
    """(group, doc, head, _h, term, tf, df): count of every n-gram in its document, and its documents in the group.

    All rows of an n-gram meet in one partition (dealt by group and head), so
    both counts are windows over one sort; ``_h``, a digest, leads that sort
    because the first bytes of a number decide what those of a text leave open.
    """
    keys = [*group, doc]
    rows = gram_rows(docs, keys, ngram_range, text)
    rows = rows.repartition(partitions, *group, "head") if partitions else rows.repartition(*group, "head")
    longer = F.concat("head", F.lit(" "), "rest")
    terms = F.when(F.col("rest").isNull(), F.array("head")).otherwise(F.array("head", longer))
    x = rows.select(*keys, "head", F.explode(terms).alias("term")).withColumn("_h", F.xxhash64("term"))
    at = [F.col("_h"), *[F.col(c) for c in group], F.col("head"), F.col("term")]
    of_doc = Window.partitionBy(*at, doc).orderBy(doc)
    whole = of_doc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.withColumn("tf", F.count(F.lit(1)).over(whole)).withColumn("_nth", F.row_number().over(of_doc)).filter(F.col("_nth") == 1).drop("_nth")
    return x.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy(*at)))


#: Characters of text that one task cuts or, with a cap, whose n-grams it sorts.
CHARS_A_TASK = 4_000_000


def top_phrases(r: DataFrame, group: list[str], n: int = 20, ngram_range: tuple[int, int] = (2, 3),
                min_df: int = FV.TFIDF_MIN_DF, cap: int | None = None, min_docs: int = FV.TFIDF_MIN_DOCS,
                text: str = TEXT, doc: str = DOC, partitions: int | None = None) -> DataFrame:
    """top-n TF-IDF phrases per group; groups under ``min_docs`` texts get F2's word counts.

    ``cap`` limits a group's vocabulary to its most frequent terms
    (``FV.TFIDF_MAX_TERMS`` is the original's); without it every term counts.
    ``partitions`` (default: by the number of terms) is the number of tasks
    that count terms, of a pass or with ``cap`` of the whole.

    Output: group columns, rank, phrase, score (truncated sum), weight
    (sum rounded to 6 dp), method ('tfidf' | 'count').
    """
    docs = r.filter(F.col(text).isNotNull() & (F.length(text) > FV.TFIDF_MIN_CHARS)).select(*group, doc, text)
    docs = docs.dropna(subset=group)  # a group has a name
    seen = docs.groupBy(*group, doc).agg(F.sum(F.length(text)).alias("chars"), F.count("*").alias("n_rows"))
    counts = seen.groupBy(*group).agg(F.count("*").alias("n_docs"), F.sum("chars").alias("chars"), F.sum("n_rows").alias("n_rows"))
    # numbered in the one partition of a table with one row per group
    counts = persisted(counts.repartition(1).withColumn("gid", F.monotonically_increasing_id().cast("int")), "groups")
    small = counts.filter(F.col("n_docs") < min_docs)
    total, fewest, twice = counts.agg(F.sum("chars"), F.min("n_docs"), F.sum(F.col("n_rows") - F.col("n_docs"))).first()
    tasks = max(r.sparkSession.sparkContext.defaultParallelism, (total or 0) // CHARS_A_TASK + 1)
    large = counts.filter(F.col("n_docs") >= min_docs)
    if cap is not None:  # a vocabulary cut by name
        tf = term_counts(docs, group, ngram_range, text, doc, partitions or tasks)
        tfidf = _tfidf(tf, large.select(*group, "n_docs"), group, n, min_df, cap, doc)
    else:
        n_docs = [x["n_docs"] for x in counts.select("gid", "n_docs").orderBy("gid").collect()]
        numbered = docs.join(F.broadcast(large.select(*group, "gid")), group).select("gid", doc, text)
        best = best_terms(numbered, phrase_tokens(F.col(text)), doc, n_docs, n, ngram_range, min_df, tasks if twice else 0, partitions)
        tfidf = _ranked(best.join(F.broadcast(large.select(*group, "gid")), "gid"), group, n)
    if fewest is None or fewest >= min_docs:  # no second pass over the texts
        return tfidf
    words = top_words(docs.join(small.select(*group), group), group, n, text=text, doc=doc)
    return tfidf.unionByName(words.withColumn("method", F.lit("count")))


def _tfidf(tf: DataFrame, counts: DataFrame, group: list[str], n: int, min_df: int, cap: int | None, doc: str) -> DataFrame:
    keys = [*group, doc]
    known = tf.filter(F.col("df") >= min_df)
    if cap is not None:
        stats = known.groupBy(*group, "term").agg(F.sum("tf").alias("ttf"))
        kept = top_k(stats, group, [F.desc("ttf"), F.col("term")], cap, rank_col="_vr").select(*group, "term")
        known = known.join(kept, [*group, "term"])
    idf = F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1
    # one row per group: small
    w = known.join(F.broadcast(counts), group).select(*keys, "term", (F.col("tf") * idf).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys)))
    scored = w.select(*group, "term", (F.col("w") / norm).alias("wn"))
    return _ranked(scored.groupBy(*group, "term").agg(F.sum("wn").alias("s")), group, n)


def _ranked(sums: DataFrame, group: list[str], n: int) -> DataFrame:
    top = top_k(sums, group, [F.desc(F.round("s", 9)), F.col("term")], n)
    return top.select(*group, "rank", F.col("term").alias("phrase"), F.floor(F.round("s", 9)).cast("long").alias("score"),
                      F.round("s", 6).alias("weight"), F.lit("tfidf").alias("method"))


def top_words(docs: DataFrame, group: list[str], n: int = 20, text: str = TEXT, doc: str = DOC,
              stop_words: list[str] | None = None, min_len: int = 3) -> DataFrame:
    """word counts over whitespace tokens (len > 3, own stop list); ties by first appearance."""
    stops = stop_words if stop_words is not None else FV.FALLBACK_STOP_WORDS
    words = docs.select(*group, doc, F.posexplode(F.split(F.lower(F.col(text)), f"{SPACE}+")).alias("pos", "word"))
    words = words.filter((F.length("word") > min_len) & ~F.col("word").isin(stops))
    agg = words.groupBy(*group, "word").agg(F.count("*").alias("cnt"), F.min(F.struct(doc, "pos")).alias("first"))
    top = top_k(agg, group, [F.desc("cnt"), F.col("first")], n)
    return top.select(*group, "rank", F.col("word").alias("phrase"), F.col("cnt").alias("score"),
                      F.col("cnt").cast("double").alias("weight"))


def phrases_by_sentiment(r: DataFrame, n: int = 6, sentiments=("Positive", "Negative")) -> DataFrame:
    """top 1-3-gram phrases per (product, sentiment)."""
    return top_phrases(r.filter(F.col("sentiment").isin(*sentiments)), ["product", "sentiment"], n, (1, 3))


def phrases_by_theme(r: DataFrame, n: int = 15, sentiment: str | None = None) -> DataFrame:
    """top 1-3-gram phrases inside each theme (optionally one sentiment)."""
    x = r if sentiment is None else r.filter(F.col("sentiment") == sentiment)
    x = x.select("product", DOC, TEXT, F.explode("themes").alias("theme"))
    return top_phrases(x, ["product", "theme"], n, (1, 3))


def phrases_by_platform(r: DataFrame, n: int = 25) -> DataFrame:
    """top 2-3-gram phrases per platform."""
    return top_phrases(r, ["product", "platform"], n, (2, 3))
