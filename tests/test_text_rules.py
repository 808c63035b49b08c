"""FIXTURES.md §6 text-rule cases through the operators on tiny frames."""

import pytest
from pyspark.sql import functions as F

from feedback_spark.operators import sentiment as D
from feedback_spark.operators import signals as G
from feedback_spark.operators import themes as E

COLS = "product string, product_type string, review_id long, platform string, review_text string, sentiment string, rating double"


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_whole_word_theme(spark):
    df = _df(spark, [("P", "logistics", 1, "reddit", "the delivery was late", "Neutral", None),
                     ("Z", "marketplace", 2, "reddit", "fast delivery every week", "Neutral", None)])
    got = {r.review_id: r.themes for r in E.tag_themes(df).collect()}
    assert "Delivery Speed" in got[1]
    # the stem 'deliver' does not match 'delivery'; 'fast' still tags the theme
    assert "Delivery & Speed" in got[2]
    stem = {r.review_id: r.themes for r in E.tag_themes(df.filter("review_id = 2").withColumn(
        "review_text", F.lit("delivery every week")), stem=True).collect()}
    assert "Delivery & Speed" in stem[2]
    plain = {r.review_id: r.themes for r in E.tag_themes(df.filter("review_id = 2").withColumn(
        "review_text", F.lit("delivery every week"))).collect()}
    assert "Delivery & Speed" not in plain[2]


def test_tags_by_words_equal_tags_by_patterns(spark):
    texts = ["", None, "late", "Late!", "latest", "_late", "late_", "l\u00e4te late\u00e9", "on time", "on-time", "onXtime", "on\ntime", "p&l", "p&lx",
             "vs  tradervue", "vs.", "cancelled sub", "canceled account", "customer\tservice", "customer service", "2fa", "22fa",
             "app store", "apps store", "fee\n", "\nfee", "fee,fee", "don't wait", "rate\u0301", "win rate", "switched\u00a0from us", "FRAUD\u2014scam"]
    types = [*E.FV.THEME_PATTERNS, "unknown", None]
    df = _df(spark, [("P", pt, 100 * j + i, "x", t, None, None) for j, pt in enumerate(types) for i, t in enumerate(texts)])
    old = df.select("review_id", E.theme_array().alias("old"))
    rows = E.tag_themes(df).join(old, "review_id").collect()
    assert len(rows) == len(texts) * len(types) and all(r.themes == r.old for r in rows)
    assert sum(bool(r.themes) for r in rows) > 30


def test_alternatives_of_a_pattern(spark):
    cut = E.split_alternatives
    assert cut(r"\b(a|b c|d(e|f)|[|)]x|\|y|z)\b") == (["a", "z"], ["b c", "d(e|f)", "[|)]x", r"\|y"], [])
    for odd in (r"\b(a)|(b)\b", r"\ba\b", "a|b", r"\b(a||b)\b"):
        assert cut(odd) == ([], [], [odd])
    patterns = {"t": [("Words", r"\b(a|b)\b"), ("Other form", r"\bsheets?\b"), ("Phrase", r"\b(b c)\b")]}
    df = _df(spark, [("P", "t", 1, "x", "b c", None, None), ("P", "t", 2, "x", "my sheet", None, None), ("P", "t", 3, "x", "ab", None, None)])
    got = {r.review_id: r.themes for r in E.tag_themes(df, patterns=patterns).collect()}
    assert got == {1: ["Words", "Phrase"], 2: ["Other form"], 3: []}


def test_texts_are_cut_once(spark):
    df = _df(spark, [("P", "logistics", 1, "x", "late", None, None)])
    plan = E.tag_themes(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("lower(") == 1


def test_theme_flags(spark):
    rows = [(1, ["A"], "new | A"), (2, [], None), (3, None, "a'b")]
    df = spark.createDataFrame(rows, "review_id long, themes array<string>, llm string")
    flags = {r.review_id: r.theme_flags for r in E.theme_flags(df, known=["A", "B"]).collect()}
    assert flags == {1: {"A": True, "B": False}, 2: {"A": False, "B": False}, 3: {"A": False, "B": False}}
    llm = {r.review_id: r.theme_flags for r in E.theme_flags(df, known=["A", "B"], llm_col="llm").collect()}
    assert llm == {1: {"A": True, "B": False, "new": True}, 2: {"A": False, "B": False}, 3: {"A": False, "B": False, "a'b": True}}
    assert E.theme_flags(df.limit(0), known=["A"]).count() == 0


def test_wide_themes_have_a_stated_limit(spark):
    df = spark.createDataFrame([(i, [], f"t{i}") for i in range(20)], "review_id long, themes array<string>, llm string")
    assert len([c for c in E.themes_wide(df, known=["K"], llm_col="llm", limit=20).columns if c.startswith("theme_")]) == 21
    with pytest.raises(ValueError, match="theme_flags"):
        E.themes_wide(df, known=["K"], llm_col="llm", limit=19)


def test_feature_request_rules(spark):
    text = "Decent tool. It would be nice if it had dark mode for the night"
    df = _df(spark, [("P", "logistics", 1, "reddit", text, "Neutral", None),
                     ("P", "logistics", 2, "reddit", text, "Positive", None),
                     ("P", "logistics", 3, "reddit", "Our team would love to see your order and it would be great if you wait", "Negative", None),
                     ("P", "logistics", 4, "reddit", "It would be nice if x", "Negative", None)])
    got = G.feature_requests(df).collect()
    assert [(r.snippet, r.n) for r in got] == [("It would be nice if it had dark mode for the night", 1)]


def test_churn_rules(spark):
    df = _df(spark, [("P", "logistics", 1, "reddit", "Too slow. I cancelled my subscription last week", "Negative", None),
                     ("P", "logistics", 2, "reddit", "please cancel the order for me now", "Negative", None)])
    got = G.churn_sentences(df).collect()
    assert [r.snippet for r in got] == ["I cancelled my subscription last week"]


def test_competitor_self_excluded(spark):
    df = _df(spark, [("Zepto", "marketplace", 1, "reddit", "ZEPTO is faster than Blinkit", "Neutral", None)])
    got = {r.competitor: r.mentions for r in G.competitor_mentions(df).collect()}
    assert got == {"Blinkit": 1}


def test_success_story_correction(spark):
    base = "I was struggling and losing money, stressed and angry, now this journal helped me become profitable"
    df = _df(spark, [("E", "trading_journal", 1, "reddit", base, None, None),
                     ("E", "trading_journal", 2, "reddit", base + " but I want a refund", None, None),
                     ("E", "trading_journal", 3, "reddit", base, None, 2.0)])
    got = {r.review_id: (r.sentiment, r.sentiment_score) for r in D.score_lexicon_lane(df).collect()}
    assert got[1] == ("Positive", 0.35)
    assert got[2][0] != "Positive" or got[2][1] != 0.35
    assert got[3] == ("Negative", -0.5)          # the rating lane wins


def test_rating_lane_fall_through(spark):
    df = _df(spark, [("E", "trading_journal", i, "x", "great great great", None, r)
                     for i, r in enumerate([1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0])])
    got = {r.rating: (r.sentiment, r.sentiment_score) for r in D.score_lexicon_lane(df).collect()}
    assert got[1.0] == ("Negative", -1.0) and got[2.0] == ("Negative", -0.5)
    assert got[3.0] == ("Neutral", 0.0) and got[4.0] == ("Positive", 0.5) and got[5.0] == ("Positive", 1.0)
    # 2 < r < 3 and 3 < r < 4 fall through to the lexicon
    assert got[2.5][0] == "Positive" and got[2.5][1] == got[3.5][1] != 0.0


def test_negation_and_booster(spark):
    df = _df(spark, [("E", "t", 1, "x", "good", None, None), ("E", "t", 2, "x", "not good", None, None),
                     ("E", "t", 3, "x", "very good", None, None), ("E", "t", 4, "x", "good but bad", None, None)])
    raw = {r.review_id: r.sentiment_raw for r in D.lexicon_polarity(df).collect()}
    assert raw[2] < 0 < raw[1] < raw[3]
    assert raw[4] < 0


def test_stem_search_matches_python(spark):
    import random
    import re

    from feedback_spark.operators import themes as E

    patterns = [r"\b(delay|late|on.?time)\b", r"\b(a?b|ac)\b", r"\b(x|[yz]a|ünd)\b", r"\b(b*c|cd{2})\b", r"\b(a|b)x\b", r"\b(fee)s?\b"]
    rnd = random.Random(5)
    words = ["delays", "late", "xlate", "on-time", "on time", "ontimely", "b", "abc", "ac", "c", "bbc", "bcd", "cdd", "yak", "zoo", "ünder", "hünd", "ax", "bx", "fees", "_fee", "é", "7late"]
    texts = ["", *words, *["".join(rnd.choice(words) + rnd.choice([" ", ".", "-", "\n", "", "é"]) for _ in range(5)) for _ in range(300)]]
    df = spark.createDataFrame([(i, "t", x) for i, x in enumerate(texts)], "review_id long, product_type string, review_text string")
    tagged = E.tag_themes(df, stem=True, patterns={"t": [(str(k), p) for k, p in enumerate(patterns)]})
    for row in tagged.collect():
        want = [str(k) for k, p in enumerate(patterns) if re.search(E._stem(p), row.review_text.lower())]
        assert row.themes == want, (row.review_text, row.themes, want)
    assert E._search_stem(patterns[0]).startswith("(?=[dlo])") and not E._search_stem(patterns[1]).startswith("(?=")


def test_trim_takes_the_same_characters_as_the_pattern(spark):
    from pyspark.sql import functions as F
    from feedback_spark.functions.regex import TRIM_PATTERN
    from feedback_spark.functions.text import clean_text

    points = [(c, chr(c)) for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(points, "cp int, c string")
    text = F.concat(F.col("c"), F.lit("\n"), F.col("c"), F.lit("a "), F.col("c"), F.lit("b"), F.col("c"), F.lit("\r\n"), F.col("c"))
    x = df.select("cp", "c", text.alias("t")).withColumn("want", F.regexp_replace("t", TRIM_PATTERN, ""))
    assert x.filter(clean_text("t") != F.col("want")).count() == 0
    assert x.filter(clean_text("c") != F.regexp_replace("c", TRIM_PATTERN, "")).count() == 0
    assert [r[0] for r in spark.createDataFrame([("",), (" 　\t",), (None,)], "t string").select(clean_text("t")).collect()] == ["", "", None]
    # no pattern is tried at every blank of a text
    assert "regexp_replace" not in df.select(clean_text("c").alias("c"))._jdf.queryExecution().optimizedPlan().toString()
