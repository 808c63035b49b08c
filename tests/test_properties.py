
from pyspark.sql import functions as F

from feedback_spark.operators import clean as C
from feedback_spark.operators import enrich as K
from feedback_spark.operators import metrics as M
from feedback_spark.operators import themes as E
from feedback_spark.plans.base import clean_layer, scored_layer, scored_plan
from feedback_spark.sources.testdata import reviews

SF = "/root/testdata/sf0.001"


def test_dedup_bounds_and_stability(spark):
    raw = C.clean_reviews(reviews(spark, SF))
    d1 = {(r.product, r.review_id) for r in C.dedup_first(raw).collect()}
    d8 = {(r.product, r.review_id) for r in C.dedup_first(raw.repartition(7)).collect()}
    assert d1 == d8
    assert len(d1) == raw.select("product", "review_text").distinct().count() <= raw.count()


def test_themes_idempotent_and_sums(spark):
    r = scored_layer(spark, SF).cache()
    again = E.tag_themes(r.drop("themes"))
    assert r.select("review_id", "themes").exceptAll(again.select("review_id", "themes")).count() == 0
    h4 = M.theme_mentions(r).agg(F.sum("mentions")).first()[0]
    h11 = M.theme_platform_matrix(r).agg(F.sum("mentions")).first()[0]
    assert h4 == h11
    h2 = M.sentiment_distribution(r).agg(F.sum("n")).first()[0]
    assert h2 == r.filter(F.col("sentiment").isNotNull()).count()


def test_partition_count_invariance(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(map(tuple, M.theme_stats(scored_plan(spark, SF)).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = sorted(map(tuple, M.theme_stats(scored_plan(spark, SF)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_pending_plus_done_is_input(spark):
    r = C.min_length(clean_layer(spark, SF))
    done = r.filter(F.pmod("review_id", F.lit(3)) == 0).withColumn("enrich_status", F.lit("parsed"))
    pend = K.pending(r, done)
    assert pend.count() + done.count() == r.count()


def test_with_seq_dense(spark):
    r = C.with_seq(clean_layer(spark, SF), ["product", "review_id"], group=["product"])
    per = r.groupBy("product").agg(F.min("review_seq").alias("lo"), F.max("review_seq").alias("hi"),
                                   F.count("*").alias("n"), F.countDistinct("review_seq").alias("d")).collect()
    for p in per:
        assert p.lo == 1 and p.hi == p.n == p.d


def test_tfidf_same_without_broadcast(spark):
    from feedback_spark.operators import phrases as PH

    r = scored_layer(spark, SF)
    a = sorted(map(tuple, PH.top_phrases(r, ["product"], 10, (1, 2)).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # forces the shuffle-join path
    try:
        b = sorted(map(tuple, PH.top_phrases(r, ["product"], 10, (1, 2)).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b and len(a) > 0
