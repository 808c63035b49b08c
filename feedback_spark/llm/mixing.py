"""Mixing to target weights by soft domain membership, in DataFrame expressions only.

1. A word classifier (naive Bayes, words of the labelled table's commonest
   ``MOST_WORDS``) is fitted on a labelled table by one aggregate.
2. Each document gets posteriors over the domains: the log weights of its words
   in the broadcast word table (bounded) are added up per document,
   tempered so that a long text counts as ``EVIDENCE`` words at most.
3. Rates r >= lower minimise the squared gap between the expected domain token
   totals sum(n * p_d * r) and the targets, by projected gradient.  A step is a
   function of the posteriors and a handful of numbers, so each pass is one
   aggregate over the narrow posterior table, and no rates are stored between.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import all_columns, free_prefix, materialise

#: Labelled rows that the classifier is fitted on at most, words of its table, domains at most.
MOST_LABELLED, MOST_WORDS, MOST_DOMAINS = 20_000, 4096, 64
#: Words that a text's evidence counts for at most; share of the natural totals' exponent (below 1: flatter).
EVIDENCE, FLATTEN = 15.0, 0.5
#: Gradient passes at most, and the relative gap that ends them.
PASSES, CLOSE = 25, 1e-4
MARK = "\x00"


def words_of(text: Column) -> Column:
    """Lower-case runs between white space (an empty string where white space begins or ends the text)."""
    return F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+")


def number_of(words: Column) -> Column:
    """Words without the empty strings at the ends."""
    n = F.size(words)
    return (n - (F.element_at(words, 1) == "").cast("int") - ((n > 1) & (F.element_at(words, -1) == "")).cast("int")).cast("long")


class Classifier:
    """Word table (word, w_0 .. w_k) and log shares of the domains, in the order of ``domains``."""

    def __init__(self, words: DataFrame, domains: list[str], prior: list[float]):
        self.words, self.domains, self.prior = words, domains, prior


def fit_classifier(labelled: DataFrame, most_labelled: int = MOST_LABELLED, most_words: int = MOST_WORDS) -> Classifier | None:
    """From ``labelled`` (text, domain): about ``most_labelled`` rows at most, drawn in place; None without any labelled row."""
    rows = labelled.where("domain is not null").select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("domain").cast("string").alias("domain"))
    n = rows.count()
    sample = materialise(rows if n <= most_labelled else rows.where(F.rand(13) < most_labelled / n), "labelled")
    shares = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().orderBy(F.desc("count"), "domain").collect()}  # at most most_labelled rows
    if not shares:
        return None
    if len(shares) > MOST_DOMAINS:  # the smallest ones share the domain ``other``
        main = list(shares)[:MOST_DOMAINS - 1]
        sample = sample.withColumn("domain", F.when(F.col("domain").isin(main), F.col("domain")).otherwise(F.lit("other")))
        shares = {d: shares[d] for d in main} | {"other": sum(n for d, n in shares.items() if d not in main)}
    domains = sorted(shares)
    counts = sample.select("domain", F.explode(words_of(F.col("text"))).alias("word")).where("word <> ''").groupBy("word").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"c_{i}") for i, d in enumerate(domains)])
    counts = materialise(counts.orderBy(F.desc("n"), "word").limit(most_words), "words")
    totals = counts.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(f"c_{i}"), F.lit(0)).alias(f"c_{i}") for i in range(len(domains))]).first()
    weights = [F.log((F.col(f"c_{i}") + 0.5) / F.lit(totals[f"c_{i}"] + 0.5 * totals["v"] + 0.5)).alias(f"w_{i}") for i in range(len(domains))]
    table = materialise(counts.select("word", *weights), "weights")
    none = table.sparkSession.createDataFrame([(MARK, *[0.0] * len(domains))], table.schema)  # finds every document once
    return Classifier(table.where(F.col("word") != MARK).unionByName(none), domains, [math.log(shares[d] / sum(shares.values())) for d in domains])


def posteriors(docs: DataFrame, model: Classifier, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per (doc_id, text_hash): copies (equal rows), n_tokens (words of one copy), p (array, adds up to 1)."""
    k = len(model.domains)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), words_of(F.col(text)).alias("words"))
    words = split.select("doc_id", "text_hash", number_of(F.col("words")).alias("n"), F.explode(F.concat(F.array(F.lit(MARK)), F.col("words"))).alias("word"))
    known = words.join(F.broadcast(model.words), "word")  # at most MOST_WORDS rows; other words weigh nothing
    mark = F.col("word") == MARK
    sums = known.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(mark, 1)).alias("copies"), F.sum(F.when(mark, F.col("n"))).alias("n"), F.count(F.when(~mark, 1)).alias("hits"),
        *[F.sum(f"w_{i}").alias(f"s_{i}") for i in range(k)])
    sums = sums.withColumn("scale", F.when(F.col("hits") > 0, F.lit(1.0) / F.greatest(F.col("copies").cast("double"), F.col("hits") / EVIDENCE)).otherwise(F.lit(0.0)))
    logit = F.array(*[F.lit(model.prior[i]) + F.col(f"s_{i}") * F.col("scale") for i in range(k)])
    odds = F.transform("logit", lambda x: F.exp(x - F.array_max("logit")))
    return sums.withColumn("logit", logit).withColumn("odds", odds).select(
        "doc_id", "text_hash", "copies", F.floor(F.col("n") / F.col("copies")).alias("n_tokens"),
        F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda a, y: a + y)).alias("p"))


def rate_column(steps: list[list[float]], lower: float, upper: float) -> Column:
    """The rate after the given steps from 1, each clipped to [lower, upper]."""
    r = F.lit(1.0)
    for step in steps:
        moved = sum((F.col("p")[i] * F.lit(g) for i, g in enumerate(step)), F.lit(0.0))
        r = F.greatest(F.lit(lower), F.least(F.lit(upper), r - moved))
    return r


def expected(table: DataFrame, rate: Column, k: int) -> list[float]:
    """Domain token totals under the rates (k numbers)."""
    weighted = table.withColumn("m", F.col("copies") * F.col("n_tokens") * rate)
    row = weighted.agg(*[F.sum(F.col("m") * F.col("p")[i]).alias(f"t_{i}") for i in range(k)]).first()
    return [row[f"t_{i}"] or 0.0 for i in range(k)]


def target_totals(natural: list[float], domains: list[str], targets: dict[str, float] | None, flatten: float) -> list[float]:
    """Token totals to reach: the natural sum, dealt by ``targets`` or by natural shares to the power ``flatten``."""
    raw = [max(0.0, targets.get(d, 0.0)) for d in domains] if targets else [x ** flatten for x in natural]
    return [sum(natural) * x / sum(raw) if sum(raw) else x for x in raw]


def solve(table: DataFrame, domains: list[str], targets: dict[str, float] | None = None, flatten: float = FLATTEN,
          lower: float = 0.0, upper: float = math.inf, passes: int = PASSES) -> tuple[list[list[float]], dict[str, tuple[float, float]]]:
    """Steps of the projected gradient, and by domain (expected total, target).

    The gap of each domain is divided by its natural total; the steps' matrix
    then has rows that add up to 1, so a step of length 1 never overshoots.
    """
    k = len(domains)
    natural = expected(table, F.lit(1.0), k)
    goal = target_totals(natural, domains, targets, flatten)
    if lower > 0 and targets is None:  # rates from ``lower`` up: as much of everything as the scarcest target allows
        grow = max((n / g for n, g in zip(natural, goal, strict=True) if g > 0), default=1.0)
        goal = [g * grow * lower for g in goal]
    steps: list[list[float]] = []
    at = natural
    while len(steps) < passes:
        step = [(a - g) / n if n > 0 else 0.0 for a, g, n in zip(at, goal, natural, strict=True)]
        if max((abs(x) for x in step), default=0.0) < CLOSE:
            break
        steps.append(step)
        now = expected(table, rate_column(steps, lower, upper), k)
        if sum(abs(x - y) for x, y in zip(now, at, strict=True)) <= CLOSE * sum(natural):
            at = now
            break
        at = now
    return steps, dict(zip(domains, zip(at, goal, strict=True), strict=True))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, flatten: float = FLATTEN, lower: float = 0.0, upper: float = math.inf) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_tokens, domain (likeliest; ties to the first name), p (array), domains, rate.

    ``targets``: weights of the domains (unnamed ones 0); without, natural
    shares to the power ``flatten``.  A null or empty text gets the domains'
    shares as posteriors and counts no tokens; repeated rows get equal rates.
    Without a labelled row there is one domain, ``all``, and every rate is 1.
    An empty table gives no rows; other columns are left out.
    """
    model = fit_classifier(labelled)
    if model is None:
        whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
        split = docs.select("doc_id", F.xxhash64(whole).alias("text_hash"), words_of(F.col("text")).alias("words"))
        return split.select("doc_id", "text_hash", number_of(F.col("words")).alias("n_tokens"), F.lit("all").alias("domain"),
                           F.array(F.lit(1.0)).alias("p"), F.array(F.lit("all")).alias("domains"), F.lit(1.0).alias("rate"))
    table = materialise(posteriors(docs, model), "posteriors", rows=2 * docs.count())
    steps, _ = solve(table, model.domains, targets, flatten, lower, upper)
    names = F.array(*[F.lit(d) for d in model.domains])
    best = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    rated = table.select("doc_id", "text_hash", "copies", "n_tokens", best.alias("domain"), "p", names.alias("domains"), rate_column(steps, lower, upper).alias("rate"))
    return rated.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def resample(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part, and one more by a hash of id and text."""
    pre = free_prefix(docs)
    rate, own_id, own_hash, text_hash, times_ = (pre + x for x in ("rate", "id", "hash", "text_hash", "times"))
    one = rates.groupBy("doc_id", "text_hash").agg(F.max("rate").alias(rate)).withColumnsRenamed({"doc_id": own_id, "text_hash": own_hash})
    keyed = docs.withColumn(text_hash, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    luck = F.pmod(F.xxhash64("doc_id", text_hash, F.lit(17)), F.lit(1_000_000)) / F.lit(1e6)
    times = (F.floor(rate) + (luck < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
    joined = keyed.join(one, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(text_hash) == F.col(own_hash)))
    return joined.withColumn(times_, times).where(F.col(times_) > 0).withColumn(times_, F.explode(F.sequence(F.lit(1), F.col(times_)))).select(*all_columns(docs))
