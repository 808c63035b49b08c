"""Inputs that the generated tables lack, each with the result worked out by hand or by Python's re."""

import json
import re

import pytest
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import portable
from feedback_spark.functions.text import between_fences, flatten_themes, parse_themes
from feedback_spark.functions.topk import top_k
from feedback_spark.operators import enrich as K
from feedback_spark.operators import explore as J
from feedback_spark.operators import metrics as M
from feedback_spark.operators import phrases as PH
from feedback_spark.operators import sentiment as D
from feedback_spark.operators.themes import themes_wide
from feedback_spark.session import SQL_DEFAULTS, get_spark
from feedback_spark.streaming import stream as S


@pytest.mark.parametrize("text,want", [
    ('["Driver\'s attitude","UX"]', ["Driver's attitude", "UX"]), ("['a', 'b']", ["a", "b"]), ("x | y", ["x", "y"]), ("", []), (None, []), ("[]", [])])
def test_parse_themes(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_themes("t")).first()[0] == want


@pytest.mark.parametrize("pattern", [r"crash|\bbug\b", r"(\blate|\bslow)", r"\bapp\b crash", r"no\b", r"caf\w+\b"])
def test_search_follows_python(spark, pattern):
    texts = ["bug report here", "debugging", "late again", "too slow", "slowly", "the APP crash", "app crashes", "no", "nothing", "Café crème", "été", "plate"]
    df = spark.createDataFrame([("P", i, t) for i, t in enumerate(texts)], "product string, review_id long, review_text string")
    want = [i for i, t in enumerate(texts) if re.search(pattern, t, re.I)]
    assert sorted(r["review_id"] for r in J.search_text(df, pattern).collect()) == want
    assert sorted(r["review_id"] for r in J.search_any(df, pattern, ["review_text"]).collect()) == want


def test_portable_rejects_an_inner_boundary():
    assert portable(r"\bbug\b") and portable(r"a\b|b\b") and portable(r"(a|b\b)")
    for p in (r"crash|\bbug\b", r"(\blate)", r"a\bb"):
        with pytest.raises(ValueError):
            portable(p)


def test_themes_given_as_text_stay(spark):
    body = json.dumps([{"idx": 1, "themes": "UX"}, {"idx": 2, "themes": ["A", "B"]}, {"idx": 3}, {"idx": 4, "themes": ""}])
    raw = spark.createDataFrame([("batches/p_response_b01.json", body), ("batches/q_response_b01.json", body + " done")], "file string, body string")
    got = K.parse_responses(raw, 5).withColumn("flat", flatten_themes("themes")).collect()
    assert {(r["slug"], r["idx"], r["flat"], r["method"]) for r in got} == {
        (s, i, f, m) for s, m in (("p", "direct"), ("q", "salvaged")) for i, f in ((1, "UX"), (2, "A | B"), (3, ""), (4, ""))}


def test_wide_matrix_has_every_platform_asked_for(spark):
    rows = [("P", 1, "google_maps", ["UX"]), ("P", 2, "reddit", ["UX"]), ("P", 3, "reddit", ["Price"])]
    df = spark.createDataFrame(rows, "product string, review_id long, platform string, themes array<string>")
    got = {r["theme"]: (r["google_maps"], r["reddit"]) for r in M.theme_platform_pivot(df, ["reddit", "google_maps"]).collect()}
    assert got == {"UX": (1, 1), "Price": (0, 1)}


def test_top_k_is_limited_before_the_shuffle(spark):
    from feedback_spark.plans.base import scored_layer

    r = scored_layer(spark, "/root/testdata/sf0.001")
    for df in (J.quotes(r), J.theme_quotes(r), J.head(r, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchange = plan.index("Exchange hashpartitioning")
        assert re.search(r"WindowGroupLimit.*Partial", plan[exchange:]), plan
    for df in (J.quotes(r), J.theme_quotes(r)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "review_text" not in plan[:plan.index("Partial")]
    df = spark.createDataFrame([("g", i) for i in range(50)], "g string, v long")
    assert [(r["v"], r["rank"]) for r in top_k(df, ["g"], [F.col("v")], 3).orderBy("rank").collect()] == [(0, 1), (1, 2), (2, 3)]


def test_nothing_is_capped(spark):
    docs = [("P", i, " ".join(f"term{i % 40:03d}x{j}" for j in range(200))) for i in range(80)]
    df = spark.createDataFrame(docs, "product string, review_id long, review_text string")
    assert PH.top_phrases(df, ["product"], 10_000, (1, 1)).count() == 8000 > FV.TFIDF_MAX_TERMS
    assert PH.top_phrases(df, ["product"], 10_000, (1, 1), cap=50).count() == 50
    r = spark.createDataFrame([("P", "t", "reddit", None, None, "y" * 3000, 1)], "product string, product_type string, platform string, rating double, date date, review_text string, review_seq long")
    products = spark.createDataFrame([("P", "t", "d")], "product string, product_type string, description string")
    assert "y" * 3000 in K.batch_prompts(r, products).first()["prompt"]
    cut = K.batch_prompts(r, products, max_chars=FV.PROMPT_TEXT_CHARS).first()["prompt"]
    assert "y" * 600 in cut and "y" * 601 not in cut
    wide = spark.createDataFrame([("P", i, [], f"theme{i}") for i in range(1200)], "product string, review_id long, themes array<string>, llm string")
    assert len([c for c in themes_wide(wide, known=["k"], llm_col="llm").columns if c.startswith("theme_theme")]) == 1200
    lexicon = spark.createDataFrame([(f"word{i}", 1.0) for i in range(60_000)], "token string, valence double")
    one = spark.createDataFrame([(1, "word59999")], "review_id long, review_text string")
    assert D.lexicon_polarity(one, lexicon).first()["sentiment_raw"] > 0


def test_lane_without_lexicon(spark):
    r = spark.createDataFrame([("A", 1, "good", 5.0, "Positive"), ("B", 2, "bad", None, None)], "product string, review_id long, review_text string, rating double, llm_sentiment string")
    products = spark.createDataFrame([("A", True), ("B", False)], "product string, use_llm boolean")
    got = {x["product"]: (x["sentiment_lane"], x["sentiment"], x["sentiment_score"]) for x in D.score_sentiment(r, products, use_lexicon=False).collect()}
    assert got == {"A": ("llm", "Positive", 0.5), "B": ("none", "Unknown", 0.0)}
    given = r.withColumn("sentiment", F.lit("Negative")).withColumn("sentiment_score", F.lit(-0.7))
    got = {x["product"]: (x["sentiment_lane"], x["sentiment"]) for x in D.score_sentiment(given, products, use_lexicon=False).collect()}
    assert got == {"A": ("llm", "Positive"), "B": ("given", "Negative")}
    kept = D.score_sentiment(r, products).collect()
    assert {x["review_text"] for x in kept} == {"good", "bad"}


@pytest.mark.parametrize("text,want", [("```json\n{\"a\": 1}\n``` tail", '{"a": 1}'), (" ```\nx```", "x"), ("plain ``` y", "plain ``` y"), ("```json {}", "{}")])
def test_between_fences(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(between_fences("t")).first()[0] == want


def test_merge_keeps_only_what_is_wanted(spark):
    done = spark.createDataFrame([("P", "a", 1), ("P", "b", 2)], "product string, review_text string, x int")
    new = spark.createDataFrame([("P", "c", 3)], "product string, review_text string, x int")
    assert sorted(r["x"] for r in K.merge_incremental(done, new).collect()) == [1, 2, 3]
    keep = spark.createDataFrame([("P", "b"), ("P", "b")], "product string, review_text string")
    assert sorted(r["x"] for r in K.merge_incremental(done, new, keep).collect()) == [2, 3]


def test_deployment_settings_win(spark):
    spark.sparkContext  # noqa: B018  (the session of the tests names 8 partitions and AQE)
    s = get_spark(shuffle_partitions=77)
    assert s.conf.get("spark.sql.shuffle.partitions") == "8"
    given = s.sparkContext.getConf()
    assert all(given.contains(k) or s.conf.get(k) == v for k, v in SQL_DEFAULTS.items())


def test_layer_follows_its_input(spark, tmp_path):
    from feedback_spark.plans.base import clean_layer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = f"{tmp_path}/documents.parquet"
    docs.limit(50).write.parquet(path)
    a = clean_layer(spark, str(tmp_path)).count()
    docs.limit(120).write.mode("overwrite").parquet(path)
    assert clean_layer(spark, str(tmp_path)).count() > a


def test_late_rows_and_evicted_state(spark):
    import datetime
    import os

    root = S.work_dir(spark, "late")
    landing, out, ckpt = (os.path.join(root, x) for x in ("in", "out", "ckpt"))

    def land(rows):
        cols = "review_id long, product string, product_type string, platform string, date date, author string, rating double, review_text string, source_url string"
        spark.createDataFrame([(i, "P", "t", "p", datetime.date(2026, m, d) if m else None, "a", None, x, "u") for i, m, d, x in rows], cols).coalesce(1).write.mode("append").parquet(landing)

    def run():
        q = (S.clean_stream(S.read_landing(spark, landing), "10 days").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r["review_id"] for r in spark.read.parquet(out).collect())

    text = "a text that is long enough {}".format
    land([(1, 1, 1, text(1)), (2, 1, 1, text(1)), (3, 3, 1, text(3)), (4, 0, 0, text(4))])
    assert len(run()) == 2  # one of the copies, and 3; the undated row has its own branch
    land([(5, 3, 2, text(3)), (6, 1, 2, text(6)), (7, 3, 3, text(7))])
    assert run()[-1] == 7 and 5 not in run() and 6 not in run()  # a copy in time; a row behind the watermark
    undated = S.undated(S.read_landing(spark, landing))
    q = undated.writeStream.format("parquet").option("path", f"{out}-undated").option("checkpointLocation", f"{ckpt}-undated").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["review_id"] for r in spark.read.parquet(f"{out}-undated").collect()] == [4]


def test_grids_read_their_layer_once(spark):
    from feedback_spark.plans.base import scored_layer

    r = scored_layer(spark, "/root/testdata/sf0.001")
    for df in (M.theme_summary(r), M.theme_platform_matrix(r)):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_no_machine_local_checkpoints_on_a_cluster():
    from types import SimpleNamespace

    from feedback_spark.session import checkpoint_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(cluster)
