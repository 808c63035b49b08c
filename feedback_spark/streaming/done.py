"""Which texts are done, in a form of which a small batch reads little.

The digests of done (product, text) pairs are dealt over parts by their first bits.
Beside each part lies a Bloom filter in blocks of 32,768 bits, built with Spark's
bitmap aggregates.  A batch reads the filter blocks of the parts that its own digests
fall into, and then the digests of those parts in which a filter says "perhaps".

A part is to hold about ``KEYS_A_PART`` digests whatever the table's size: when the
parts have grown to four times that, the table is dealt anew over more of them and
published as a new version (``sources.layers``).  So what a batch of n texts reads is
bounded by n parts of bounded size.  Folders are addressed by name, never listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark.session import path_exists
from feedback_spark.sources import layers

#: Digests of a part, and of a table that still has one part; the most bits that number the parts.
KEYS_A_PART, MOST_BITS = 100_000, 16
#: Bits of a filter block (fixed by Spark's bitmap functions), blocks of a part, bits set for a digest.
BLOCK_BITS, BLOCKS, HASHES = 32_768, 32, 5


def digest(product: str = "product", text: str = "review_text") -> Column:
    """128 bits of (product, text) as 32 hex digits; a null product counts as empty, a null text gives null."""
    return F.md5(F.concat(F.coalesce(F.col(product), F.lit("")), F.lit("\x00"), F.col(text)))


def _word(key: Column, k: int) -> Column:
    """The digest's k-th 16 bits as a number."""
    return F.conv(F.substring(key, 4 * k + 1, 4), 16, 10).cast("int")


def part_of(key: Column, bits: int) -> Column:
    return F.shiftright(_word(key, 0), MOST_BITS - bits)


def _block(key: Column) -> Column:
    return F.pmod(_word(key, 1), F.lit(BLOCKS))


def _places(key: Column) -> Column:
    return F.array(*[F.pmod(_word(key, 2 + k), F.lit(BLOCK_BITS)) for k in range(HASHES)])


def bloom_blocks(keys: DataFrame) -> DataFrame:
    """part, block, bits (binary) of ``keys`` (key, part)."""
    return (keys.select("part", _block(F.col("key")).alias("block"), F.explode(_places(F.col("key"))).alias("place"))
            .groupBy("part", "block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits")))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1


def _parts(spark: SparkSession, root: str, name: str, wanted: list[int], schema: str) -> DataFrame:
    """The rows of some parts; only their folders are touched."""
    found = [p for p in (f"{root}/{name}/part={k}" for k in wanted) if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], schema + ", part int")
    return spark.read.schema(schema + ", part int").option("basePath", f"{root}/{name}").parquet(*found)


class DoneTable:
    """The table at ``path``; empty until something is added."""

    def __init__(self, spark: SparkSession, path: str, keys_a_part: int = KEYS_A_PART):
        self.spark, self.path, self.keys_a_part = spark, path.rstrip("/"), keys_a_part

    def state(self) -> tuple[str | None, int, int]:
        """Version, bits that number the parts, digests (about)."""
        facts = layers.facts(self.spark, self.path)
        return layers.current_version(self.spark, self.path), facts.get("bits", 0), facts.get("keys", 0)

    def _seen(self, keys: DataFrame, but_batch: int | None) -> DataFrame | None:
        """Those of ``keys`` (key, part) that are in the table."""
        version, _, _ = self.state()
        if version is None:
            return None
        root = f"{self.path}/{version}"
        # one small number a part, of at most 2 ** MOST_BITS
        wanted = sorted(r["part"] for r in keys.select("part").distinct().collect())
        blocks = _parts(self.spark, root, "bloom", wanted, "block int, bits binary").groupBy("part", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        asked = keys.withColumn("block", _block(F.col("key"))).join(blocks, ["part", "block"])
        perhaps = asked.where(F.forall(_places(F.col("key")), lambda p: _is_set(F.col("bits"), p))).select("key", "part")
        likely = sorted(r["part"] for r in perhaps.select("part").distinct().collect())
        held = _parts(self.spark, root, "keys", likely, "key string, batch_id long")
        if but_batch is not None:
            held = held.where(F.col("batch_id") != but_batch)
        return perhaps.join(held.select("key").distinct(), "key", "left_semi").select("key")

    def unseen(self, rows: DataFrame, but_batch: int | None = None) -> DataFrame:
        """``rows`` (product, review_text, ...) whose pair is not in the table (added by ``but_batch`` does not count).

        Rows without a text have no digest and are never seen.
        """
        keyed = rows.withColumn("_key", digest())
        _, bits, _ = self.state()
        keys = keyed.where(F.col("_key").isNotNull()).select(F.col("_key").alias("key")).distinct().withColumn("part", part_of(F.col("key"), bits))
        seen = self._seen(keys, but_batch)
        return rows if seen is None else keyed.join(seen.withColumnRenamed("key", "_key"), "_key", "left_anti").select(*rows.columns)

    def add(self, rows: DataFrame, batch_id: int = 0) -> None:
        """Add the pairs of ``rows``; a batch that is run again adds nothing twice that matters (equal keys are one)."""
        keys = rows.select(digest().alias("key")).where(F.col("key").isNotNull()).distinct()
        version, bits, n = self.state()
        if version is None:
            version = layers.new_version()
        n += self._append(keys, f"{self.path}/{version}", bits, batch_id)
        if n > 4 * self.keys_a_part << bits and bits < MOST_BITS:
            self._deal(version, n)
        else:
            layers.point_to(self.spark, self.path, version, about={"bits": bits, "keys": n})

    def _append(self, keys: DataFrame, root: str, bits: int, batch_id: int | None = None) -> int:
        """Write keys (with their batch_id, unless one is given) and their filter blocks; returns how many."""
        dealt = keys.withColumn("part", part_of(F.col("key"), bits))
        if batch_id is not None:
            dealt = dealt.withColumn("batch_id", F.lit(batch_id).cast("long"))
        dealt = dealt.select("key", "batch_id", "part").repartition("part")
        dealt.write.mode("append").partitionBy("part").parquet(f"{root}/keys")
        bloom_blocks(dealt).write.mode("append").partitionBy("part").parquet(f"{root}/bloom")
        return dealt.count()

    def _deal(self, version: str, n: int) -> None:
        """Deal all digests anew, so that a part holds about ``keys_a_part``; readers keep the old version meanwhile."""
        bits = min(MOST_BITS, max(0, (n // self.keys_a_part).bit_length()))
        old = self.spark.read.schema("key string, batch_id long, part int").parquet(f"{self.path}/{version}/keys")
        fresh = layers.new_version()
        n = self._append(old.groupBy("key").agg(F.min("batch_id").alias("batch_id")), f"{self.path}/{fresh}", bits)
        layers.point_to(self.spark, self.path, fresh, about={"bits": bits, "keys": n})
