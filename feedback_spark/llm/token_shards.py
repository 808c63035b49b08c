"""Token ids in training order: fixed-stride shards in a global, keyed permutation.

1. Each document is encoded whole, closed by the end mark and cut into
   sequences of ``length`` ids (the last one padded); task and place within the
   task are written with the rows, so a retried reader sees the same numbers.
2. The tasks' counts (one number each) give every sequence its number i in 0..N-1.
3. A keyed Feistel network over the next even number of bits permutes i; results
   of N or more are walked on along their cycle until they fall below N.  The
   outcome is the sequence's slot: a permutation that any worker computes alone.
4. Rows are range-partitioned by shard and sorted by slot; each task writes its
   shards one after the other: a row per shard whose payload holds ``slots``
   sequences of the same stride, in slot order.

Spark's Parquet writer commits the shards, so lost executors leave no torn
files, and a reader resumes at any slot: shard = slot // slots, offset =
(slot % slots) * stride.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import SparkSession

from feedback_spark.llm.common import materialise, new_folder, python_ready
from feedback_spark.llm.pretokens import worker_state

#: Ids of a sequence, sequences of a shard, rounds of the Feistel network, shards that one task writes.
LENGTH, SLOTS, ROUNDS, SHARDS_A_TASK = 512, 1024, 6, 8
#: Compression of the sequences' and shards' tables.
CODEC = "zstd"


def encoding(ranks: bytes, pattern: str):
    """The tokenizer of a .tiktoken file's bytes, without special tokens."""
    import tiktoken

    lines = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={})


def round_keys(key: str, rounds: int = ROUNDS) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little") for r in range(rounds)]


def feistel(i, n: int, keys: list[int]):
    """Slots of the numbers ``i`` (0 <= i < n): a keyed permutation of 0..n-1, by cycle-walking."""
    import numpy as np

    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)

    def once(x):
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            m = (right ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
            m = (m ^ (m >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((m ^ (m >> np.uint64(32))) & low)
        return (left << np.uint64(half)) | right

    x = once(np.asarray(i, np.uint64))
    while (far := x >= np.uint64(n)).any():
        x[far] = once(x[far])
    return x.astype(np.int64)


def slot_of(number: Column, n: int, key: str) -> Column:
    keys = round_keys(key)

    @F.pandas_udf("long")
    def slots(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(feistel(part.to_numpy(), n, keys))

    return slots(number)


def sequences(docs: DataFrame, ranks: bytes, pattern: str, end: int, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """part, pos, doc_id, seq_no, n_tokens, payload (``length`` little-endian 16-bit ids, padded with the end mark)."""
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(ranks)
    key = f"shards:{zlib.crc32(ranks)}:{zlib.crc32(pattern.encode())}"

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc = worker_state(key, lambda: encoding(sent.value, pattern))
        part, pos = TaskContext.get().partitionId(), 0
        for b in batches:
            take, numbers, sizes, payloads = [], [], [], []
            for row, t in enumerate(b.column("text").to_pylist()):
                ids = enc.encode_to_numpy(t or "", disallowed_special=())
                count = len(ids) // length + 1
                padded = np.full(count * length, end, "<u2")
                padded[:len(ids)] = ids
                raw = padded.tobytes()
                take += [row] * count
                numbers += range(count)
                sizes += [length] * (count - 1) + [len(ids) + 1 - (count - 1) * length]
                payloads += [raw[k * 2 * length:(k + 1) * 2 * length] for k in range(count)]
            cols = [pa.array(np.full(len(take), part), pa.int32()), pa.array(np.arange(pos, pos + len(take)), pa.int64()), b.column("doc_id").take(pa.array(take, pa.int64())),
                    pa.array(numbers, pa.int32()), pa.array(sizes, pa.int32()), pa.array(payloads, pa.binary())]
            pos += len(take)
            yield pa.RecordBatch.from_arrays(cols, ["part", "pos", "doc_id", "seq_no", "n_tokens", "payload"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(encode, "part int, pos long, doc_id long, seq_no int, n_tokens int, payload binary")


def write_shards(docs: DataFrame, ranks: bytes, pattern: str, end: int, key: str, path: str, text: str = "text", doc_id: str = "doc_id",
                 length: int = LENGTH, slots: int = SLOTS) -> int:
    """Write the shard table to ``path`` (Parquet): shard, first_slot, n, stride, payload, doc_ids, seq_nos, sizes.  Returns N.

    A null or empty text gives one sequence that holds the end mark only;
    repeated rows give their sequences each; null ids are carried along; an
    empty table gives an empty shard table; other columns are left out.
    """
    spark = docs.sparkSession
    made = materialise(sequences(docs, ranks, pattern, end, text, doc_id, length), "sequences", codec=CODEC)
    counts = sorted((r["part"], r["count"]) for r in made.groupBy("part").count().collect())  # one row a task
    n = sum(c for _, c in counts)
    start, at = [], 0
    for part, c in counts:
        start.append((part, at))
        at += c
    offsets = spark.createDataFrame(start, "part int, start long")
    placed = made.join(F.broadcast(offsets), "part").withColumn("slot", slot_of(F.col("start") + F.col("pos"), max(1, n), key))  # one row a task
    placed = placed.select(F.floor(F.col("slot") / slots).alias("shard"), "slot", "doc_id", "seq_no", "n_tokens", "payload")
    tasks = max(1, -(-n // (slots * SHARDS_A_TASK)))
    dealt = placed.repartitionByRange(tasks, "shard").sortWithinPartitions("slot")

    def assemble(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(shard: int, held: list):
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([held[0][0]], pa.int64()), pa.array([len(held)], pa.int32()), pa.array([2 * length], pa.int32()),
                                               pa.array([b"".join(h[4] for h in held)], pa.binary()), pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                                               pa.array([[h[2] for h in held]], pa.list_(pa.int32())), pa.array([[h[3] for h in held]], pa.list_(pa.int32()))],
                                              ["shard", "first_slot", "n", "stride", "payload", "doc_ids", "seq_nos", "sizes"])

        at, held = None, []
        for b in batches:
            for shard, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "slot", "doc_id", "seq_no", "n_tokens", "payload")), strict=True):
                if held and shard != at:
                    yield out(at, held)
                    held = []
                at = shard
                held.append(row)
        if held:
            yield out(at, held)

    dealt.mapInArrow(assemble, SHARD_SCHEMA).write.parquet(path, compression=CODEC)
    return n


SHARD_SCHEMA = "shard long, first_slot long, n int, stride int, payload binary, doc_ids array<long>, seq_nos array<int>, sizes array<int>"


def unpacked(shards: DataFrame, last: str) -> DataFrame:
    """A row per sequence of shard rows, in slot order: slot, shard, doc_id, seq_no, n_tokens, and ``ids`` or ``crc``."""
    python_ready(shards.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1)
                shard, first, n, stride = (row.column(c)[0].as_py() for c in ("shard", "first_slot", "n", "stride"))
                whole = memoryview(row.column("payload")[0].as_buffer())
                parts = [whole[k * stride:(k + 1) * stride] for k in range(n)]
                given = pa.array([p.tobytes() for p in parts], pa.binary()) if last == "ids" else pa.array([zlib.crc32(p) for p in parts], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n), pa.int64()), pa.array(np.full(n, shard), pa.int64()), row.column("doc_ids").flatten(),
                                                  row.column("seq_nos").flatten(), row.column("sizes").flatten(), given], ["slot", "shard", "doc_id", "seq_no", "n_tokens", last])

    kind = {"ids": "binary", "crc": "long"}[last]
    return shards.mapInArrow(cut, f"slot long, shard long, doc_id long, seq_no int, n_tokens int, {last} {kind}")


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None, slots: int = SLOTS) -> DataFrame:
    """slot, shard, doc_id, seq_no, n_tokens, ids (binary) of the slots first..last (ends included), to resume a run."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).where(F.col("shard") >= first // slots)
    if last is not None:
        shards = shards.where(F.col("shard") <= last // slots)
    rows = unpacked(shards, "ids").where(F.col("slot") >= first)
    return rows if last is None else rows.where(F.col("slot") <= last)


def training_order(docs: DataFrame, ranks: bytes, pattern: str, end: int, key: str, length: int = LENGTH, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Write the shards and read them back: slot, shard, doc_id, seq_no, n_tokens, crc (CRC-32 of the sequence's bytes in its shard)."""
    spark = docs.sparkSession
    path = path or new_folder(spark, "shards")
    write_shards(docs, ranks, pattern, end, key, path, length=length, slots=slots)
    return unpacked(spark.read.schema(SHARD_SCHEMA).parquet(path), "crc")
