"""D2 against a plain-Python implementation of the same per-token rules."""

import math
import random

from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.operators.sentiment import lexicon_polarity

LEX = dict(FV.DEFAULT_LEXICON)
VOCAB = list(LEX) + FV.BOOSTER_UP + FV.BOOSTER_DOWN + FV.NEGATION_WORDS + ["but", "app", "the", "it", "least", "at", "very"]


def brute(text: str, idioms: dict | None = None, lex: dict = LEX) -> float:
    import re
    raw = re.findall(r"[\w']+", text)
    toks = [t.lower() for t in raw]
    shouts = [t.isupper() for t in raw]
    mixed = 0 < sum(shouts) < len(raw)
    if idioms:  # the longest at each place becomes one token
        lex, out, at = {**lex, **idioms}, [], 0
        while at < len(toks):
            n = next((n for n in range(len(toks) - at, 0, -1) if " ".join(toks[at:at + n]) in idioms), 0)
            name = " ".join(toks[at:at + n]) if n else toks[at]
            out.append((("\0" if n else "") + name, all(shouts[at:at + max(n, 1)])))
            at += max(n, 1)
        lex = {**lex, **{"\0" + k: v for k, v in idioms.items()}}
        toks, shouts = [t for t, _ in out], [c for _, c in out]
    but = toks.index("but") if "but" in toks else None
    s = 0.0
    for i, t in enumerate(toks):
        if t not in lex:
            continue
        v = lex[t]
        boost, neg = 0.0, False
        for d in (1, 2, 3):
            if i - d < 0:
                continue
            p = toks[i - d]
            step = FV.BOOSTER_STEP if p in FV.BOOSTER_UP else -FV.BOOSTER_STEP if p in FV.BOOSTER_DOWN else 0.0
            if step and mixed and shouts[i - d]:
                step += 0.733
            boost += step * FV.BOOSTER_DISTANCE_SCALE[d - 1]
            neg = neg or p in FV.NEGATION_WORDS
        boost += 0.733 if mixed and shouts[i] else 0.0
        v = v + boost if v > 0 else v - boost
        if i and toks[i - 1] == "least" and not (i > 1 and toks[i - 2] in ("at", "very")):
            v *= FV.NEGATION_SCALE
        if neg:
            v *= FV.NEGATION_SCALE
        if but is not None:
            v *= FV.BUT_BEFORE if i < but else FV.BUT_AFTER if i > but else 1.0
        s += v
    amp = min(text.count("!"), FV.EXCLAIM_MAX) * FV.EXCLAIM_STEP
    asks = text.count("?")
    amp += 0.96 if asks > 3 else 0.18 * asks if asks > 1 else 0.0
    s = s + amp if s > 0 else s - amp if s < 0 else s
    return round(max(-1.0, min(1.0, s / math.sqrt(s * s + FV.COMPOUND_ALPHA))), 4)


def test_lexicon_matches_bruteforce(spark):
    rnd = random.Random(11)
    def word():
        w = rnd.choice(VOCAB)
        return w.upper() if rnd.random() < 0.3 else w.title() if rnd.random() < 0.1 else w

    texts = [" ".join(word() for _ in range(rnd.randrange(0, 14))) + "!" * rnd.randrange(0, 6) + "?" * rnd.randrange(0, 6)
             for _ in range(600)]
    texts += [t.upper() for t in texts[:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")
    got = {r.review_id: r.sentiment_raw for r in lexicon_polarity(df).collect()}
    for i, t in enumerate(texts):
        assert abs(got[i] - brute(t)) < 1e-9, (t, got[i], brute(t))


IDIOMS = {"good app": -2.0, "good app the": 3.0, "not": -1.5, "very bad": 2.5, "but great": 1.0, "app": 0.5, "the least": -1.0}


def random_texts(n, seed):
    rnd = random.Random(seed)
    words = VOCAB + ["good", "app", "the", "not", "very", "bad", "but", "great"] * 6
    word = lambda: (w := rnd.choice(words)) and (w.upper() if rnd.random() < 0.3 else w)
    return [" ".join(word() for _ in range(rnd.randrange(0, 14))) + "!" * rnd.randrange(0, 3) for _ in range(n)]


def test_idioms_match_bruteforce(spark):
    texts = random_texts(500, 3) + ["GOOD APP the", "good APP", "", "good  app, the"]
    df = spark.createDataFrame([*enumerate(texts), (10_000, None)], "review_id long, review_text string")
    got = {r.review_id: r.sentiment_raw for r in lexicon_polarity(df, idioms=spark.createDataFrame(list(IDIOMS.items()), "idiom string, valence double")).collect()}
    for i, t in enumerate(texts):
        assert abs(got[i] - brute(t, IDIOMS)) < 1e-9, (t, got[i], brute(t, IDIOMS))


def test_large_lexicon_is_joined_with_equal_scores(spark):
    texts = random_texts(400, 4)
    texts += texts[:50]  # copies
    df = spark.createDataFrame([*enumerate(texts), (10_000, None)], "review_id long, review_text string").repartition(4)
    lexicon = spark.createDataFrame(list(LEX.items()), "token string, valence double")
    for idioms in (None, list(IDIOMS.items())):
        joined = lexicon_polarity(df, lexicon, idioms=idioms, most_collected=10 if idioms is None else 20)
        small = lexicon_polarity(df, lexicon, idioms=idioms)
        assert joined.columns == small.columns
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, small.collect()), key=str)


def test_five_million_words_stay_distributed(spark):
    lexicon = spark.range(5_000_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("token"), (F.col("id") % 7 - 3).cast("double").alias("valence"))
    df = spark.createDataFrame([(1, "w4999999 and w12 or W5"), (2, "nothing")], "review_id long, review_text string")
    words = {"w4999999": float(4999999 % 7 - 3), "w12": 2.0, "w5": 2.0}
    assert {r.review_id: r.sentiment_raw for r in lexicon_polarity(df, lexicon).collect()} == {1: brute("w4999999 and w12 or W5", lex=words), 2: 0.0}


def test_scorer_memory_is_bounded_by_a_run_of_rows(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from feedback_spark.operators import sentiment as D

    words = ["not", "very", "good", None, None, "but", "bad"]
    rows = [[words[(i * 7 + k * k) % 7] if (k + i) % 9 == 0 else None for k in range(i % 1500)] for i in range(3000)] + [None, []]
    args = pa.array(rows, pa.list_(pa.string())), pa.array([[]] * len(rows), pa.list_(pa.int32())), pa.array([[]] * len(rows), pa.list_(pa.float64()))
    score = D._token_valence_sum(list(LEX), list(LEX.values()), {})
    tracemalloc.start()
    whole = score(*args)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak  # 2.2 million tokens
    for most in (1, 1000, 10**9):
        monkeypatch.setattr(D, "TOKENS_AT_ONCE", most)
        assert score(*args).equals(whole), most
