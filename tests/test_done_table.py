"""Done-table lookup (K18, M3): exact answers, and a small batch reads a bounded share of the table."""

import os

from pyspark.sql import functions as F

from feedback_spark.streaming import done as D
from feedback_spark.streaming.stream import work_dir


def some(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("p"), (F.col("id") % 3).cast("string")).alias("product"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("review_text"), "id")


def table(spark, **kw):
    return D.DoneTable(spark, os.path.join(work_dir(spark, "done"), "keys"), **kw)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_empty_table_and_null_texts(spark):
    t = table(spark)
    assert ids(t.unseen(some(spark, 0, 5))) == [0, 1, 2, 3, 4]
    t.add(some(spark, 0, 3))
    odd = spark.createDataFrame([("p0", None, 7), (None, "text 0", 8), ("p0", "text 0", 9), ("p0", "text 0", 10)], "product string, review_text string, id long")
    assert ids(t.unseen(odd)) == [7, 8]
    t.add(odd.where("id = 8"))
    assert ids(t.unseen(odd)) == [7]
    assert ids(t.unseen(odd.limit(0))) == []


def test_same_answers_over_batches_and_deals(spark):
    t = table(spark, keys_a_part=50)
    known = 0
    for b, n in enumerate((30, 200, 400, 700)):
        batch = some(spark, max(0, known - 20), known + n)  # overlaps what is there
        fresh = t.unseen(batch, but_batch=b)
        assert ids(fresh) == list(range(known, known + n))
        t.add(fresh, b)
        known += n
        assert ids(t.unseen(some(spark, 0, known + 5))) == list(range(known, known + 5))
    version, bits, n = t.state()
    assert bits >= 3 and n == known
    held = spark.read.parquet(f"{t.path}/{version}/keys")
    assert held.select("key").distinct().count() == held.count() == known


def test_repeated_batch_sees_past_its_own_keys(spark):
    t = table(spark)
    t.add(some(spark, 0, 10), 0)
    t.add(some(spark, 10, 20), 1)  # written, but the run ended before the batch was committed
    assert ids(t.unseen(some(spark, 5, 25), but_batch=1)) == list(range(10, 25))
    assert ids(t.unseen(some(spark, 5, 25))) == list(range(20, 25))


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    keys = some(spark, 0, 2000).select(D.digest().alias("key")).withColumn("part", F.lit(0))
    blocks = D.bloom_blocks(keys)
    asked = some(spark, 0, 6000).select("id", D.digest().alias("key")).withColumn("block", D._block(F.col("key")))
    hit = asked.join(blocks.select("block", "bits"), "block").where(F.forall(D._places(F.col("key")), lambda p: D._is_set(F.col("bits"), p)))
    found = ids(hit)
    assert found[:2000] == list(range(2000)) and len(found) < 2000 + 40


def read_files(df):
    return df.inputFiles()


def test_small_batch_reads_few_parts_of_bounded_size(spark, monkeypatch):
    read: list = []
    real = D._parts

    def seen(spark_, root, name, wanted, schema):
        out = real(spark_, root, name, wanted, schema)
        read.extend((name, os.path.getsize(f.removeprefix("file://"))) for f in read_files(out))
        return out

    sizes = []
    for n in (2_000, 16_000):  # eight times the table
        t = table(spark, keys_a_part=250)
        t.add(some(spark, 0, n))
        with monkeypatch.context() as m:
            m.setattr(D, "_parts", seen)
            read.clear()
            assert ids(t.unseen(some(spark, n, n + 3))) == [n, n + 1, n + 2]
            assert all(name == "bloom" for name, _ in read)  # new texts: the filter suffices
            assert len(read) <= 3
            read.clear()
            assert ids(t.unseen(some(spark, 5, 8))) == []
            sizes.append(sum(size for _, size in read))
            assert len([x for x in read if x[0] == "keys"]) <= 3
    assert sizes[1] < 1.5 * sizes[0]
