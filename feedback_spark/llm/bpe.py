"""BPE encoding and decoding by tree concatenation.

Ordinary texts are a map pass: white-space runs through a bounded cache of ids.
A text with a long run without white space takes the tree's way:

1. The run is normalised and split as the tokenizer file says.  A pre-token (the
   unit inside which BPE merges) longer than a leaf is cut into leaves, and the
   leaves are dealt over tasks and encoded apart from each other.  Only the last
   leaf of a pre-token ends a word, so the others use the same merges without the
   end-of-word mark.
2. Neighbouring halves are joined pairwise up a tree.  At a join a window of the
   last tokens of the left and the first of the right half is encoded again; it
   doubles until its first token is the left half's and its last token the right
   half's at these places (or it reaches the end of a half).

BPE is decided by neighbouring tokens: a sequence is the encoding of its text if
and only if each pair of neighbours is the encoding of its own text.  When the
window agrees with both halves, every pair of the joined sequence has been seen
inside one encoding, so the result is exactly that of the whole.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, python_ready
from feedback_spark.llm.pretokens import Misses, read_file, tokenizer_of, worker_state

#: Characters from which a run without white space is long, and characters of a leaf.
LONG_RUN, LEAF = 4096, 2048
#: Tokens taken from each half in the first window of a join.
WINDOW = 8


class Codec:
    """A tokenizer file's parts: whole runs, pre-tokens, and merges with or without the end-of-word mark."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        self.tok = tokenizer_of(spec)
        self.ends = self.tok.model
        suffix = d["model"].get("end_of_word_suffix") or ""
        d["model"]["end_of_word_suffix"] = None
        self.inner = tokenizer_of(json.dumps(d)).model if suffix else self.ends
        size = max([-1, *self.tok.get_vocab(with_added_tokens=True).values()]) + 1
        self.tokens = [self.tok.id_to_token(i) for i in range(size)]
        self.plain = [t[:len(t) - len(suffix)] if suffix and t and t.endswith(suffix) else t for t in self.tokens]
        self.split = ascii_split(d)
        self.words = Misses(lambda word: packed(self.piece_ids(word, True)))
        added = sorted((t.content for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None

    def run_ids(self, run: bytes) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if self.split and run.isascii() and (word := run.decode()).isprintable() and not (self.special and self.special.search(word)):
            return b"".join([self.words[w] for w in self.split.findall(word.lower())])
        return packed(self.tok.encode(run.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def pretokens(self, run: str) -> Iterator[tuple[str, bool]]:
        """The run's pre-tokens in the model's alphabet; True: a special string, to be encoded as it is."""
        at = 0
        for m in [*(self.special.finditer(run) if self.special else ()), None]:
            part = run[at:m.start()] if m else run[at:]
            part = self.tok.normalizer.normalize_str(part) if self.tok.normalizer and part else part
            for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(part) if part else ():
                yield piece, False
            if m:
                yield m[0], True
                at = m.end()

    def piece_ids(self, piece: str, end: bool) -> list[int]:
        """Ids of a stretch of one pre-token; ``end``: the word ends with it."""
        return [t.id for t in (self.ends if end else self.inner).tokenize(piece)]

    def again(self, ids: list[int], end: bool) -> list[int]:
        """The ids of neighbouring tokens' text, encoded anew."""
        return self.piece_ids("".join([self.plain[i] for i in ids]), end)


def ascii_split(spec: dict):
    """The pattern that cuts printable ASCII without blanks into pre-tokens, where the file's rules do no more to it than lower-casing."""
    import regex

    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    kinds = [x["type"] for x in steps]
    if kinds.count("Lowercase") != 1 or set(kinds) - {"NFC", "Replace", "Lowercase"} or any(x["pattern"] != {"Regex": r"\s+"} for x in steps if x["type"] == "Replace"):
        return None
    if [x["type"] for x in cuts] != ["Split", "ByteLevel"] or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
        return None
    return regex.compile(cuts[0]["pattern"]["Regex"]) if "Regex" in cuts[0]["pattern"] else None


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids: bytes) -> list[int]:
    import numpy as np

    return np.frombuffer(ids, "<u4").tolist()


def join(left: list[int], right: list[int], again: Callable[[list[int], bool], list[int]], end: bool, window: int = WINDOW) -> list[int]:
    """Encoding of the text of ``left`` and ``right``, each the encoding of its own; ``end``: the word ends with ``right``."""
    while True:
        i, j = min(window, len(left)), min(window, len(right))
        mid = again(left[len(left) - i:] + right[:j], end and j == len(right))
        if (i == len(left) or mid[:1] == left[-i:][:1]) and (j == len(right) or mid[-1:] == right[j - 1:j]):
            return left[:len(left) - i] + mid + right[j:]
        window *= 2


def tree(leaves: list[list[int]], again: Callable[[list[int], bool], list[int]]) -> list[int]:
    """Pairwise joins of a pre-token's leaves, round by round; the last leaf ends the word."""
    while len(leaves) > 1:
        last = len(leaves) - len(leaves) % 2
        leaves = [join(leaves[k], leaves[k + 1], again, k + 2 == len(leaves)) for k in range(0, last, 2)] + leaves[last:]
    return leaves[0]


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), long_run: int = LONG_RUN, leaf: int = LEAF) -> DataFrame:
    """One row per input row: the ``keep`` columns and ``ids`` (binary: little-endian unsigned 32-bit integers).

    Ids are the library's for the whole text without added special tokens,
    truncation or padding; special strings in a text are handled as its
    default.  A null or empty text has no ids; repeated rows are encoded each;
    an empty table gives no rows; other columns, whatever their names, are left
    out.  Very long unsplit texts are encoded in parts on several tasks; a
    task holds a document's ids at most.
    """
    spark = docs.sparkSession
    python_ready(spark)
    spec = read_file(tokenizer_path)
    sent = spark.sparkContext.broadcast(spec)
    key = f"bpe:{zlib.crc32(spec.encode())}"

    def codec() -> tuple[Codec, Misses]:
        def build():
            c = Codec(sent.value)
            return c, Misses(c.run_ids)

        return worker_state(key, build)

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, runs = codec()
        for b in batches:
            ids = [b"".join([runs[r] for r in t.split()]) for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.binary())], schema=pa.schema([*list(b.schema)[:-1], pa.field("ids", pa.binary())]))

    def cut(batches: Iterator) -> Iterator:
        """Rows (row, part, leaf, body): ids of what is short (leaf -1), or a leaf of a long pre-token as text."""
        import pyarrow as pa

        c, runs = codec()
        for b in batches:
            for row, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                done, out, part = [], [], 0
                for run in t.split():
                    if len(run) <= leaf:
                        done.append(runs[run])
                        continue
                    for piece, special in c.pretokens(run.decode("utf-8", "replace")):
                        if special:
                            done.append(c.run_ids(piece.encode()))
                        elif len(piece) <= leaf:
                            done.append(packed(c.piece_ids(piece, True)))
                        else:
                            out.append((row, part, -1, False, b"".join(done)))
                            n = -(-len(piece) // leaf)
                            out += [(row, part + 1, k, k + 1 == n, piece[k * leaf:(k + 1) * leaf].encode()) for k in range(n)]
                            done, part = [], part + 2
                out.append((row, part, -1, False, b"".join(done)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types(pa), strict=True)], names)

    names, types = ["row", "part", "leaf", "end", "body"], lambda pa: (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())

    def leaves(batches: Iterator) -> Iterator:
        import pyarrow as pa

        c, _ = codec()
        for b in batches:
            ids = [body if k < 0 else packed(c.piece_ids(body.decode(), end)) for k, end, body in zip(*(b.column(x).to_pylist() for x in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.binary())], names)

    def combined(held):
        """One document's parts in order, the leaves of each long pre-token joined up the tree."""
        import pyarrow as pa

        c, _ = codec()
        held = held.sort_by([("part", "ascending"), ("leaf", "ascending")])
        rows = list(zip(*(held.column(x).to_pylist() for x in ("part", "leaf", "body")), strict=True))
        done, at = [], 0
        while at < len(rows):
            if rows[at][1] < 0:
                done.append(rows[at][2])
                at += 1
                continue
            to = at
            while to < len(rows) and rows[to][0] == rows[at][0]:
                to += 1
            done.append(packed(tree([unpacked(x[2]) for x in rows[at:to]], c.again)))
            at = to
        return pa.table({"row": pa.array(held.column("row").to_pylist()[:1], pa.int64()), "ids": pa.array([b"".join(done)], pa.binary())})

    kept = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).toDF(*[f"c{i}" for i in range(len(keep))], "text")
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields[:-1])] + ["ids binary"])
    is_long = F.col("text").rlike(rf"[^\x20\x09-\x0D]{{{long_run}}}")
    short = kept.where(~is_long).mapInArrow(whole, schema)
    unsplit = materialise(kept.where(is_long).withColumn("row", F.monotonically_increasing_id()), "unsplit")
    parts = materialise(unsplit.select("row", "text").mapInArrow(cut, "row long, part int, leaf int, end boolean, body binary"), "leaves")
    coded = parts.repartition("row", "part", "leaf").mapInArrow(leaves, "row long, part int, leaf int, end boolean, body binary")
    joined = coded.groupBy("row").applyInArrow(combined, "row long, ids binary")
    return short.unionByName(unsplit.drop("text").join(joined, "row").drop("row")).toDF(*keep, "ids")


def decode(coded: DataFrame, tokenizer_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the ``keep`` columns and ``text``, the library's decoding with special tokens kept.

    ``ids`` as from ``encode``; null counts as none, and gives an empty text.  Ids that
    the tokenizer lacks are passed over, as the library does.
    """
    spark = coded.sparkSession
    python_ready(spark)
    spec = read_file(tokenizer_path)
    sent = spark.sparkContext.broadcast(spec)
    key = f"unbpe:{zlib.crc32(spec.encode())}"

    def build():
        tok = tokenizer_of(sent.value)
        if tok.decoder is not None:
            return lambda one: tok.decode(unpacked(one), skip_special_tokens=False).encode()
        known = {i: t.encode() for t, i in tok.get_vocab(with_added_tokens=True).items()}
        # without a decoder the library joins the tokens themselves with blanks
        return lambda one: b" ".join([known[i] for i in unpacked(one) if i in known])

    def texts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        one = worker_state(key, build)
        for b in batches:
            out = pa.array([one(x or b"") for x in b.column(b.num_columns - 1).to_pylist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], out], schema=pa.schema([*list(b.schema)[:-1], pa.field("text", pa.string())]))

    kept = coded.select(*keep, F.col(ids).alias("ids")).toDF(*[f"c{i}" for i in range(len(keep))], "ids")
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields[:-1])] + ["text string"])
    return kept.mapInArrow(texts, schema).toDF(*keep, "text")
