"""Staged publish of layers (A4, K19): what counts is a whole version, whatever happens to a write."""

import os

import pytest
from pyspark.sql import functions as F

from feedback_spark.sources import layers as L
from feedback_spark.streaming.stream import work_dir


def rows(spark, *items):
    return spark.createDataFrame([("P", t, n) for t, n in items], "product string, review_text string, n int")


def texts(df):
    return sorted((r["review_text"], r["n"]) for r in df.collect())


@pytest.fixture
def layer(spark):
    return os.path.join(work_dir(spark, "layer"), "enriched")


def test_nothing_published(spark, layer):
    assert L.current_version(spark, layer) is None and L.read_layer(spark, layer) is None and L.versions(spark, layer) == []
    assert L.vacuum(spark, layer) == []


def test_failed_write_leaves_the_old_layer(spark, layer):
    first = L.publish(rows(spark, ("a", 1), ("b", 2)), layer)
    # the second task of the write fails after the first has written its file
    broken = spark.range(0, 1000, 1, 4).select(F.lit("P").alias("product"), F.col("id").cast("string").alias("review_text"),
                                               F.when(F.col("id") > 900, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)).cast("int").alias("n"))
    with pytest.raises(Exception, match="lost"):
        L.publish(broken, layer)
    assert L.current_version(spark, layer) == first
    assert texts(L.read_layer(spark, layer)) == [("a", 1), ("b", 2)]
    assert len(L.versions(spark, layer)) == 2  # the unfinished one is there, and is never read
    L.publish(rows(spark, ("c", 3)), layer)
    assert texts(L.read_layer(spark, layer)) == [("c", 3)]
    assert L.vacuum(spark, layer, keep=1, unfinished_after_s=0) and L.versions(spark, layer) == [L.current_version(spark, layer)]


def test_killed_before_the_swap(spark, layer, monkeypatch):
    L.publish(rows(spark, ("a", 1)), layer)
    with monkeypatch.context() as m:
        m.setattr(L, "_point", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            L.publish(rows(spark, ("z", 9)), layer)
    assert texts(L.read_layer(spark, layer)) == [("a", 1)]


def test_reader_keeps_its_version(spark, layer):
    L.publish(rows(spark, ("a", 1), ("b", 2)), layer)
    reader = L.read_layer(spark, layer)
    L.publish(rows(spark, ("c", 3)), layer)
    L.publish(rows(spark, ("d", 4)), layer)
    assert texts(reader) == [("a", 1), ("b", 2)]
    assert texts(L.read_layer(spark, layer)) == [("d", 4)]


def test_merge_reads_what_it_replaces(spark, layer):
    L.merge_publish(spark, layer, rows(spark, ("a", 1), ("b", 2)))
    L.merge_publish(spark, layer, rows(spark, ("c", 3)), keep=rows(spark, ("a", 0), ("x", 0)))
    assert texts(L.read_layer(spark, layer)) == [("a", 1), ("c", 3)]


def test_second_writer_does_not_lose_the_first_ones_rows(spark, layer):
    base = L.publish(rows(spark, ("a", 1)), layer)
    L.publish(rows(spark, ("a", 1), ("b", 2)), layer, based_on=base)
    with pytest.raises(L.StaleLayer):
        L.publish(rows(spark, ("a", 1), ("c", 3)), layer, based_on=base)
    assert texts(L.read_layer(spark, layer)) == [("a", 1), ("b", 2)]


def test_partitions_facts_and_empty_layers(spark, layer):
    L.publish(rows(spark, ("a", 1)), layer, partition_by=["product"], about={"rows": 1})
    assert L.facts(spark, layer) == {"rows": 1} and texts(L.read_layer(spark, layer)) == [("a", 1)]
    L.publish(rows(spark), layer)
    assert texts(L.read_layer(spark, layer)) == [] and L.facts(spark, layer) == {}


def test_vacuum_keeps_what_counts(spark, layer):
    names = [L.publish(rows(spark, ("a", k)), layer) for k in range(4)]
    assert L.vacuum(spark, layer, keep=2) == names[:2]
    assert L.versions(spark, layer) == names[2:]
    L.point_to(spark, layer, names[2])  # back to an earlier version
    assert texts(L.read_layer(spark, layer)) == [("a", 2)]
    assert L.vacuum(spark, layer, keep=1, unfinished_after_s=0) == []
