"""D: sentiment lanes.

* D1 rating lane (``when`` chain), D3 success-story correction (two ``rlike``),
  D4 labels, D5 audit columns, D6 LLM label scores: built-in expressions.
* D2 lexicon polarity: tokens are cut JVM-side with ``regexp_extract_all``;
  the per-token rules (lexicon valence, boosters and negation in the three
  preceding tokens, the ``but`` shift) run in one Arrow-vectorised function
  per batch, using pyarrow hash lookups and numpy segment sums.  No shuffle,
  no join back: the score is computed in place on the row.  Tokens outside the
  rule vocabulary are nulled in the JVM first (a hash-set test), so only
  positions and the few relevant words cross into Python.  The lexicon is a
  table: up to ``MOST_COLLECTED`` words it is collected and shipped with the
  task; a larger one stays distributed, and the texts' tokens are joined with it.
  Idioms are a small table of token sequences; the longest match counts as one
  token whose valence replaces its words'.
* D7 lane choice per product is a one-row-per-product flag joined back
  (bounded by the number of products), never a driver round trip.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import LEXICON_TOKEN, portable
from feedback_spark.functions.text import label, label_to_score


#: Marks a word in capitals on its way to the scorer.
CAPS_MARK = "^"


def lexicon_table(spark) -> DataFrame:
    return spark.createDataFrame(FV.DEFAULT_LEXICON, "token string, valence double")


#: Most tokens that the scorer holds arrays for at a time.
TOKENS_AT_ONCE = 250_000
#: Most words of a lexicon, and of the idioms, that go to the tasks by way of the driver.
MOST_COLLECTED = 100_000


def _pairs(table: DataFrame | list) -> dict[str, float]:
    """Lower-cased key -> valence of a small table or list."""
    rows = table if isinstance(table, list) else table.select(table.columns[0], "valence").collect()
    return {str(r[0]).lower(): float(r[1]) for r in rows}


def _is_large(table: DataFrame | list | None, most: int) -> bool:
    return isinstance(table, DataFrame) and table.limit(most + 1).count() > most


def idiom_trie(idioms: dict[str, float]) -> dict:
    """Token -> subtree; the key None holds the idiom that ends here."""
    root: dict = {}
    for phrase in idioms:
        at = root
        for word in phrase.split():
            at = at.setdefault(word, {})
        at[None] = phrase
    return root


def longest_idioms(tokens: list, trie: dict) -> list[tuple[int, int, str]]:
    """(start, length, idiom) of the leftmost longest matches, none overlapping, in one row's tokens."""
    found, at = [], 0
    while at < len(tokens):
        node, best = trie, None
        for k in range(at, len(tokens)):
            node = node.get(tokens[k]) if tokens[k] is not None else None
            if node is None:
                break
            if None in node:
                best = (at, k + 1 - at, node[None])
        if best:
            found.append(best)
        at += best[1] if best else 1
    return found


def _token_valence_sum(keys: list[str], vals: list[float], idioms: dict[str, float]):
    """Arrow function: token lists (and the places and valences of a joined lexicon) -> rule-adjusted valence sum per row."""
    key_arr = pa.array(keys, pa.string())
    val_np = np.asarray(vals, dtype=np.float64)
    up = pa.array(FV.BOOSTER_UP, pa.string())
    down = pa.array(FV.BOOSTER_DOWN, pa.string())
    neg = pa.array(FV.NEGATION_WORDS, pa.string())
    scales = FV.BOOSTER_DISTANCE_SCALE
    trie = idiom_trie(idioms)
    heads = pa.array(list(trie), pa.string())

    def merged(flat, caps, valence, has, row, starts, lengths):
        """Each idiom as one token: the first of its tokens stays and takes its valence."""
        head = pc.fill_null(pc.is_in(flat, value_set=heads), False).to_numpy(zero_copy_only=False)
        rows = np.unique(row[head])
        keep, named = np.ones(len(flat), dtype=bool), []
        for r in rows.tolist():
            lo = int(starts[r])
            for at, n, phrase in longest_idioms(flat.slice(lo, int(lengths[r])).to_pylist(), trie):
                at += lo
                valence[at], has[at], caps[at] = idioms[phrase], True, caps[at:at + n].all()
                keep[at + 1:at + n] = False
                named.append(at)
        if named:  # the words of an idiom neither boost nor negate nor turn the sentence
            mask = np.zeros(len(flat), dtype=bool)
            mask[named] = True
            flat = pc.if_else(pa.array(mask), pa.scalar(None, pa.string()), flat)
        return flat.filter(pa.array(keep)), caps[keep], valence[keep], has[keep], np.bincount(row[keep], minlength=len(lengths))

    def sums(tokens: pa.Array, places: pa.Array, values: pa.Array) -> np.ndarray:
        n_rows = len(tokens)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(tokens)
        total = len(flat)
        if total == 0:
            return np.zeros(n_rows)
        caps = np.array(pc.fill_null(pc.starts_with(flat, CAPS_MARK), False).to_numpy(zero_copy_only=False))
        flat = pc.utf8_ltrim(flat, characters=CAPS_MARK)
        idx = pc.index_in(flat, value_set=key_arr)
        has = np.array(pc.is_valid(idx).to_numpy(zero_copy_only=False))
        valence = np.zeros(total)
        valence[has] = val_np[pc.drop_null(idx).to_numpy()]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        joined = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if joined.any():
            at = np.repeat(starts, joined) + pc.list_flatten(places).to_numpy(zero_copy_only=False)
            valence[at], has[at] = pc.list_flatten(values).to_numpy(zero_copy_only=False), True
        row = np.repeat(np.arange(n_rows), lengths)
        if idioms:
            flat, caps, valence, has, lengths = merged(flat, caps, valence, has, row, starts, lengths)
            total, row = len(flat), np.repeat(np.arange(n_rows), lengths)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        pos = np.arange(total) - starts[row]
        # only words of the vocabulary take part in a rule: the others give their places and go
        kept = np.flatnonzero(np.array(pc.is_valid(flat).to_numpy(zero_copy_only=False)) | has | caps)
        flat, caps, valence, has, row, pos = flat.take(pa.array(kept)), caps[kept], valence[kept], has[kept], row[kept], pos[kept]
        total = len(kept)

        def member(values):
            return pc.fill_null(pc.is_in(flat, value_set=values), False).to_numpy(zero_copy_only=False)
        is_up, is_down = member(up), member(down)
        bst = (is_up.astype(np.float64) - is_down.astype(np.float64)) * FV.BOOSTER_STEP + (is_up | is_down) * caps * FV.CAPS_STEP
        least, spared = member(pa.array(["least"])), member(pa.array(FV.LEAST_SPARED))
        isneg = member(neg)
        boost = np.zeros(total)
        negated, prev_least, prev_spared = (np.zeros(total, dtype=bool) for _ in range(3))
        scale = np.array([0.0, *scales])
        for k in (1, 2, 3):  # the k-th kept word before, if it stands within three places of the same row
            far = pos[k:] - pos[:-k]
            near = (row[k:] == row[:-k]) & (far >= 1) & (far <= 3)
            boost[k:] += np.where(near, bst[:-k] * scale[np.where(near, far, 0)], 0.0)
            negated[k:] |= near & isneg[:-k]
            prev_least[k:] |= near & (far == 1) & least[:-k]
            prev_spared[k:] |= near & (far == 2) & spared[:-k]
        boost += caps * FV.CAPS_STEP
        v = np.where(valence > 0, valence + boost, np.where(valence < 0, valence - boost, 0.0))
        v = np.where(prev_least & ~prev_spared, v * FV.NEGATION_SCALE, v)
        v = np.where(negated, v * FV.NEGATION_SCALE, v)
        is_but = pc.fill_null(pc.equal(flat, "but"), False).to_numpy(zero_copy_only=False)
        first_but = np.full(n_rows, np.iinfo(np.int64).max)
        np.minimum.at(first_but, row[is_but], pos[is_but])
        fb = first_but[row]
        has_but = fb != np.iinfo(np.int64).max
        v = np.where(has_but & (pos < fb), v * FV.BUT_BEFORE, np.where(has_but & (pos > fb), v * FV.BUT_AFTER, v))
        v = np.where(has, v, 0.0)
        return np.bincount(row, weights=v, minlength=n_rows)

    def score(tokens: pa.Array, places: pa.Array, values: pa.Array) -> pa.Array:
        """The rows of a batch in runs of at most ``TOKENS_AT_ONCE`` tokens (a longer row alone): the arrays beside the batch stay small."""
        tokens, places, values = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (tokens, places, values))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        out, at = [np.zeros(0)], 0
        while at < len(tokens):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + TOKENS_AT_ONCE, side="right")))
            out.append(sums(*(x.slice(at, to - at) for x in (tokens, places, values))))
            at = to
        return pa.array(np.concatenate(out), pa.float64())

    return score


def _joined_hits(r: DataFrame, lexicon: DataFrame, text: str) -> DataFrame:
    """``_key`` (digest of the text) and ``_hits``: place and valence of the text's words that the lexicon has.

    One row per distinct text; adaptive execution splits the partition of a
    word that is everywhere.
    """
    tokens = r.select(F.md5(text).alias("_key"), F.posexplode(F.regexp_extract_all(F.lower(text), F.lit(LEXICON_TOKEN), 0)).alias("at", "token"))
    known = lexicon.groupBy(F.lower("token").alias("token")).agg(F.max("valence").cast("double").alias("valence"))
    return tokens.join(known, "token").groupBy("_key").agg(F.sort_array(F.collect_set(F.struct("at", "valence"))).alias("_hits"))


def lexicon_polarity(r: DataFrame, lexicon: DataFrame | list | None = None, text: str = "review_text",
                     idioms: DataFrame | list | None = None, most_collected: int = MOST_COLLECTED) -> DataFrame:
    """Compound polarity in [-1, 1] as ``sentiment_raw``.

    ``lexicon``: token and valence (of equal tokens the largest valence of a
    joined table).  ``idioms``: phrases of words parted by blanks, and valence;
    the leftmost longest match is one token, in capitals if all its words are.
    """
    from feedback_spark.session import ship_package

    ship_package(r.sparkSession)
    large = _is_large(lexicon, most_collected)
    known = {} if large else _pairs(FV.DEFAULT_LEXICON if lexicon is None else lexicon)
    if _is_large(idioms, most_collected):
        raise ValueError(f"more than {most_collected} idioms: they go to every task")
    phrases = _pairs(idioms) if idioms is not None else {}
    fn = F.arrow_udf(_token_valence_sum(list(known), list(known.values()), phrases), "double")
    raw = F.regexp_extract_all(F.col(text), F.lit(LEXICON_TOKEN), 0)
    relevant = set(known) | set(FV.BOOSTER_UP) | set(FV.BOOSTER_DOWN) | set(FV.NEGATION_WORDS) | set(FV.LEAST_SPARED) | {"but", "least"} | {w for p in phrases for w in p.split()}
    # positions matter, words outside the rule vocabulary do not: they cross to
    # Python as nulls (a hash-set test in the JVM), which shrinks the Arrow batches
    words = sorted(relevant)
    shouted = lambda t: (t == F.upper(t)) & (t != F.lower(t))
    columns = r.columns
    if large:
        r = r.withColumn("_key", F.md5(text)).join(_joined_hits(r, lexicon, text), "_key", "left")
    # capitals stress a word only where the text is not all in capitals; each test ends at the first such word
    r = r.withColumn("_raw", raw).withColumn("_mixed", F.exists("_raw", lambda t: ~shouted(t)) & F.exists("_raw", shouted))
    mixed = F.col("_mixed")
    marked = lambda t: F.concat(F.when(mixed & shouted(t), F.lit(CAPS_MARK)).otherwise(F.lit("")), F.lower(t))
    if large:  # a word that only the joined table has crosses by its place; its capitals cross with a mark alone
        tokens = F.transform("_raw", lambda t: F.when(F.lower(t).isin(words), marked(t)).when(mixed & shouted(t), F.lit(CAPS_MARK)))
        places, values = F.transform("_hits", lambda h: h["at"]), F.transform("_hits", lambda h: h["valence"])
    else:
        tokens = F.transform("_raw", lambda t: F.when(F.lower(t).isin(words), marked(t)))
        places, values = F.array().cast("array<int>"), F.array().cast("array<double>")
    s = fn(tokens, places, values)
    bangs = F.least(F.length(text) - F.length(F.regexp_replace(F.col(text), "!", "")), F.lit(FV.EXCLAIM_MAX))
    asks = F.length(text) - F.length(F.replace(F.col(text), F.lit("?"), F.lit("")))
    amp = bangs * FV.EXCLAIM_STEP + F.when(asks > FV.QUESTION_MANY, F.lit(FV.QUESTION_MOST)).when(asks > 1, asks * FV.QUESTION_STEP).otherwise(F.lit(0.0))
    s2 = F.when(s > 0, s + amp).when(s < 0, s - amp).otherwise(s)
    compound = s2 / F.sqrt(s2 * s2 + F.lit(FV.COMPOUND_ALPHA))
    compound = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), compound))
    return r.withColumn("sentiment_raw", F.round(compound, 4)).select(*[c for c in columns if c != "sentiment_raw"], "sentiment_raw")


def rating_sentiment(rating: Column) -> tuple[Column, Column]:
    """(label, score) from the rating; null where the rating lane does not apply."""
    lab = F.when(rating >= 4, "Positive").when(rating == 3, "Neutral").when(rating <= 2, "Negative")
    sc = F.when((rating >= 4) | (rating <= 2), F.round((rating - 3) / 2, 2)).when(rating == 3, F.lit(0.0))
    return lab, sc


def success_story(text_lc: Column) -> Column:
    """D3 predicate: success-story wording and no product complaint."""
    return text_lc.rlike(portable(FV.SUCCESS_STORY_PATTERN)) & ~text_lc.rlike(portable(FV.PRODUCT_COMPLAINT_PATTERN))


def score_lexicon_lane(r: DataFrame, lexicon: DataFrame | list | None = None) -> DataFrame:
    """Rating lane, else polarity with success correction and labels.

    Adds sentiment, sentiment_score, sentiment_raw, sentiment_corrected.
    """
    r = lexicon_polarity(r, lexicon)
    rating = F.col("rating")
    raw = F.col("sentiment_raw")
    r_lab, r_sc = rating_sentiment(rating)
    corrected = (raw < -FV.LABEL_THRESHOLD) & success_story(F.lower(F.col("review_text")))
    lab = F.coalesce(r_lab, F.when(corrected, F.lit("Positive")).otherwise(label(raw)))
    sc = F.coalesce(r_sc, F.when(corrected, F.lit(FV.SUCCESS_STORY_SCORE)).otherwise(raw))
    return (
        r.withColumn("sentiment", lab)
        .withColumn("sentiment_score", sc)
        .withColumn("sentiment_corrected", F.abs(F.col("sentiment_score") - raw) > F.lit(1e-9))
    )


def score_sentiment(r: DataFrame, products: DataFrame, lexicon: DataFrame | list | None = None,
                    llm_col: str = "llm_sentiment", use_lexicon: bool = True) -> DataFrame:
    """Lane per product.

    Allow-listed product (``products.use_llm``) with some non-null LLM label
    -> D6 label scores; otherwise the lexicon lane D1-D5.  Without a lexicon
    (``use_lexicon=False``) the rest keeps a ``sentiment`` that it already
    has, and is ``Unknown`` / 0.0 otherwise.  The flag is a window-free
    one-row-per-product aggregate joined back; texts of the LLM lane reach the
    scorer as nulls.
    """
    flags = (
        r.groupBy("product").agg(F.max(F.col(llm_col).isNotNull()).alias("_has_llm"))
        .join(products.select("product", "use_llm"), "product", "left")
        .select("product", (F.coalesce(F.col("use_llm"), F.lit(False)) & F.col("_has_llm")).alias("_llm_lane"))
    )
    marked = r.join(flags, "product", "left")
    llm = F.col("_llm_lane")
    if use_lexicon:
        text = marked.withColumn("_text", F.col("review_text")).withColumn("review_text", F.when(~llm, F.col("review_text")))
        scored, lane = score_lexicon_lane(text, lexicon).withColumn("review_text", F.col("_text")).drop("_text"), "lexicon"
    elif "sentiment" in r.columns:
        scored, lane = marked, "given"
    else:
        scored, lane = marked.withColumn("sentiment", F.lit("Unknown")).withColumn("sentiment_score", F.lit(0.0)), "none"
    return (
        scored.withColumn("sentiment_lane", F.when(llm, "llm").otherwise(lane))
        .withColumn("sentiment_score", F.when(llm, label_to_score(llm_col)).otherwise(F.col("sentiment_score")))
        .withColumn("sentiment", F.when(llm, F.col(llm_col)).otherwise(F.col("sentiment")))
        .drop("_llm_lane")
    )


def sentiment_audit(r: DataFrame) -> DataFrame:
    """Raw polarity next to the final score and the corrected flag."""
    return r.select("product", "review_id", "sentiment", "sentiment_score", "sentiment_raw", "sentiment_corrected")
