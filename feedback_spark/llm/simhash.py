"""SimHash near-duplicates with a Gray-order hierarchical index.

1. Fingerprints of whole texts, in Arrow batches (hashing per shingle).
2. Equal fingerprints collapse (partial aggregate) before anything is compared.
3. Pigeonhole keys: 64 bits in ``most + 2`` blocks; two fingerprints within
   ``most`` bits agree on at least two whole blocks, so each pair meets under
   one of the C(most + 2, 2) block choices.  Keys met once are dropped.
4. Each key's fingerprints are searched with the index of ``gray_index``, which
   gives a spanning forest, never a pair list.  A key with more than
   ``UNIT_ROWS`` fingerprints is cut along the Gray order at approximate
   quantiles; the cuts' shared bits prune whole pairs of cuts, and each pair
   left is a unit of its own, so a task holds two cuts at most.
5. Components of the forest's edges; members get the smallest document id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import all_columns, free_prefix, materialise, python_ready
from feedback_spark.llm.components import components

#: Fingerprints of one cut of a hot key, and the most cuts of one key.
UNIT_ROWS, MOST_CUTS = 4096, 1024
#: Rows a task gathers before it searches (whole units; a unit has at most two cuts).
BATCH_ROWS = 50_000
#: Hashes whose bits are counted at once.
HASHES_AT_ONCE = 65_536


def simhash(text: bytes, words: int) -> int:
    """Fingerprint of a UTF-8 text (unsigned): majority bits of the XXH64 (seed 42) of its word shingles."""
    import numpy as np
    from xxhash import xxh64_intdigest

    w = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= words:
        return xxh64_intdigest(line, 42)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    h = np.array([xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends[words - 1:], strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), HASHES_AT_ONCE):
        ones += np.unpackbits(h[k:k + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = 4) -> DataFrame:
    """One row per input row: ``keep`` columns, ``text_hash`` (of the text, null: of the empty one) and ``fp`` (long)."""
    python_ready(docs.sparkSession)

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fp = np.array([simhash(t, words) for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], schema=pa.schema([*list(b.schema)[:-1], pa.field("fp", pa.int64())]))

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = docs.select(*keep, F.xxhash64(whole).alias("text_hash"), whole.alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["fp long"])
    return kept.mapInArrow(hashed, schema)


def gray_rank(fp: Column) -> Column:
    """Place of a bit string in the reflected Gray code (order of signed longs, which is as good)."""
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp


def block_masks(most: int) -> list[int]:
    """For each choice of two of ``most + 2`` blocks of the 64 bits: the mask of their bits, as a signed long."""
    n = most + 2
    cuts = [64 * k // n for k in range(n + 1)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [((x | y) ^ (1 << 63)) - (1 << 63) for x, y in combinations(bits, 2)]


def units(fps: DataFrame, most: int, unit_rows: int = UNIT_ROWS, rows: int | None = None) -> DataFrame:
    """Distinct ``fp`` (about ``rows``) dealt into units (key choice, key, cut pair) in which every close pair meets."""
    masks = block_masks(most)
    entries = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    sizes = entries.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    some = None if rows is None else rows * len(masks)
    met = materialise(entries.join(sizes, ["t", "key"]), "entries", rows=some)
    small = met.where(F.col("n") <= unit_rows).select("t", "key", F.lit(0).alias("a"), F.lit(0).alias("b"), "fp")
    hot = met.where(F.col("n") > unit_rows).withColumn("rank", gray_rank(F.col("fp")))
    parts = F.least(F.ceil(F.col("n") / unit_rows), F.lit(MOST_CUTS))
    share = [k / MOST_CUTS for k in range(1, MOST_CUTS)]
    cuts = hot.groupBy("t", "key").agg(F.max("n").alias("n"), F.percentile_approx("rank", share, 20_000).alias("all")).select(
        "t", "key", F.filter("all", lambda x, i: F.floor((i + 1) * parts / MOST_CUTS) != F.floor(i * parts / MOST_CUTS)).alias("cuts"))
    hot = hot.join(cuts, ["t", "key"]).select("t", "key", "fp", F.size(F.filter("cuts", lambda x: x < F.col("rank"))).alias("cut"))
    hot = materialise(hot, "cuts", rows=some)
    nodes = hot.groupBy("t", "key", "cut").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some")).select(
        "t", "key", "cut", "ones", F.bitwise_not(F.col("ones").bitwiseXOR(F.col("some"))).alias("mask"))
    x, y = (nodes.select("t", "key", *[F.col(c).alias(f"{c}_{s}") for c in ("cut", "ones", "mask")]) for s in "ab")
    apart = F.bit_count(F.col("ones_a").bitwiseXOR(F.col("ones_b")).bitwiseAND(F.col("mask_a")).bitwiseAND(F.col("mask_b")))
    # among the cuts (at most MOST_CUTS of a key): the pairs that their shared bits cannot rule out; a cut alone is within any pair of it
    pairs = x.join(y, ["t", "key"]).where((F.col("cut_a") <= F.col("cut_b")) & (apart <= most))
    sides = F.when(F.col("cut_a") == F.col("cut_b"), F.array("cut_a")).otherwise(F.array("cut_a", "cut_b"))
    dealt = pairs.select("t", "key", F.col("cut_a").alias("a"), F.col("cut_b").alias("b"), F.explode(sides).alias("cut"))
    return small.unionByName(hot.join(dealt, ["t", "key", "cut"]).select("t", "key", "a", "b", "fp"))


def links(dealt: DataFrame, most: int) -> DataFrame:
    """Edges a, b of a spanning forest of each unit's close pairs."""

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from feedback_spark.llm.gray_index import spanning_links

        def found(rows: np.ndarray):
            fp = rows[-1].view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], (rows[:-1, 1:] != rows[:-1, :-1]).any(0)]))
            i, j = spanning_links(fp, starts, most)
            return pa.RecordBatch.from_arrays([pa.array(rows[-1][i]), pa.array(rows[-1][j])], ["a", "b"])

        held: list = []
        n = 0
        for b in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]))
            n += b.num_rows
            if n >= BATCH_ROWS:
                rows = np.concatenate(held, axis=1)
                change = np.flatnonzero((rows[:-1, 1:] != rows[:-1, :-1]).any(0))
                if len(change):
                    cut = change[-1] + 1
                    yield found(rows[:, :cut])
                    rows = rows[:, cut:]
                held, n = [rows], rows.shape[1]
        if n:
            yield found(np.concatenate(held, axis=1))

    keys = ["t", "key", "a", "b"]
    ordered = dealt.withColumn("rank", gray_rank(F.col("fp"))).repartition(*keys).sortWithinPartitions(*keys, "rank").select(*keys, "fp")
    return ordered.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, most: int = 4,
                    unit_rows: int = UNIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, text_hash, fp, root (a fingerprint, one per component), component_id.

    Texts are lower-cased (A-Z) and cut at ASCII white space; shingles of
    ``words`` words, repeats included; fewer words make one shingle.  A text
    without words, or null, has fingerprint zero and is linked like any other.
    Fingerprints within ``most`` bits are linked; ``component_id`` is the
    smallest doc_id of the component (null ids are passed over; null if there
    is no other).  Repeated rows share a fingerprint and keep a row each; an
    empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    rows = materialise(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), words=words), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes", rows=rows.count())
    n = classes.count()
    python_ready(spark)
    labels = components(links(units(classes.select("fp"), most, unit_rows, n), most), rows=n * len(block_masks(most))).withColumnRenamed("node", "fp")
    rooted = classes.join(labels, "fp", "left")
    linked = rooted.where("root is not null")
    first = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = materialise(linked.join(first, "root").select("fp", "root", "component_id").unionByName(
        rooted.where("root is null").select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))), "members", rows=n)
    return rows.join(known, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 4, most: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one of each component, that of the smallest doc_id.

    Of several texts under that id the one of smallest hash stays, of equal
    rows one.  A component without any id keeps one row too.
    """
    pre = free_prefix(docs)
    own_id, own_hash, times_, text_hash = (pre + x for x in ("id", "hash", "times", "text_hash"))
    members = near_duplicates(docs, text, doc_id, words, most)
    won = members.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("component_id").alias(own_id), F.min("text_hash").alias(own_hash))
    times = members.groupBy("doc_id", "text_hash").agg(F.count("*").alias(times_))
    won = won.join(times, F.col(own_id).eqNullSafe(F.col("doc_id")) & (F.col(own_hash) == F.col("text_hash"))).select(own_id, own_hash, times_)
    hashed = docs.withColumn(text_hash, F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    stay = hashed.join(won, F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.col(text_hash) == F.col(own_hash)))
    once = stay.where(F.col(times_) == 1).select(*all_columns(docs))
    more = stay.where(F.col(times_) > 1).dropDuplicates([doc_id, text_hash]).select(*all_columns(docs))
    return once.unionByName(more)
