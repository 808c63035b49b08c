"""Token counts by a map-side two-tier lookup (no shuffle of pre-tokens).

Tier 1 is a compact table of the most frequent pre-tokens' lengths: a sorted
blob of the pre-tokens and one byte per length, broadcast once and opened as a
hash table by each worker.  Tier 2 is a bounded cache in each worker; only what
both lack is encoded by the tokenizer library.  The table is fitted on a
bounded sample and changes the speed, never a count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import python_ready
from feedback_spark.llm.pretokens import MAX_KEPT_BYTES, Misses, read_file, tokenizer_of, worker_state

#: Documents (on average) that the table of frequent pre-tokens is fitted on, and its largest size.
SAMPLE_DOCS, TABLE_SIZE = 2000, 32_768


def pack_table(lengths: dict[bytes, int]) -> tuple[bytes, bytes]:
    """Pre-tokens in order, one per line, and their lengths (1 to 255) as bytes."""
    keys = sorted(k for k, n in lengths.items() if 0 <= n < 256)
    return zlib.compress(b"\n".join(keys)), bytes(lengths[k] for k in keys)


def open_table(packed: tuple[bytes, bytes]) -> dict[bytes, int]:
    blob, lengths = packed
    return dict(zip(zlib.decompress(blob).split(b"\n"), lengths, strict=True)) if lengths else {}


def frequent_pretokens(docs: DataFrame, text: str, sample_docs: int, size: int) -> list[bytes]:
    """The most frequent pre-tokens of about ``sample_docs`` documents."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                seen.update(w for w in (t or b"").split() if len(w) <= MAX_KEPT_BYTES)
        best = seen.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], ["run", "n"])

    rows = docs.count()
    if not rows:
        return []
    part = docs.where(F.rand(11) < min(1.0, sample_docs / rows)).select(F.col(text).cast("string").alias("text"))
    found: Counter = Counter()
    for r in part.mapInArrow(count, "run binary, n long").where("n > 1").collect():
        found[bytes(r["run"])] += r["n"]
    return [w for w, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:size]]


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """One row per input row: the ``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens``.

    Counts are what the library gives for the whole text without added special
    tokens, truncation or padding; special strings inside a text are handled
    as its default.  A null text counts as empty (0 and 0); repeated rows are
    counted each; an empty table gives no rows; other columns, whatever their
    names, are left out.
    """
    spark = docs.sparkSession
    python_ready(spark)
    spec = read_file(tokenizer_path)
    tok = tokenizer_of(spec)
    runs = frequent_pretokens(docs, text, sample_docs, table_size)
    coded = tok.encode_batch([w.decode() for w in runs], add_special_tokens=False) if runs else []
    sent = spark.sparkContext.broadcast((spec, pack_table({w: len(e.ids) for w, e in zip(runs, coded, strict=True)})))
    key = f"counts:{zlib.crc32(spec.encode())}:{zlib.crc32(sent.value[1][0])}"

    def build():
        spec, packed = sent.value
        tok = tokenizer_of(spec)
        misses = Misses(lambda run: len(tok.encode(run.decode(), add_special_tokens=False).ids))
        return open_table(packed), misses

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        first, misses = worker_state(key, build)
        for b in batches:
            n_bytes, n_tokens = [], []
            for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist():
                t = t or b""
                lengths = list(map(first.get, t.split()))
                if None in lengths:
                    n = sum(misses[run] if n is None else n for run, n in zip(t.split(), lengths, strict=True))
                else:
                    n = sum(lengths)
                n_bytes.append(len(t))
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], schema=pa.schema([*list(b.schema)[:-1], pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64())]))

    kept = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["n_bytes long", "n_tokens long"])
    return kept.mapInArrow(count, schema)
