"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language is turned into a suffix
automaton.  A text is parsed against each automaton: the longest match from
where the parse stands is one phrase, then the next begins.  The language with
the least phrases * log2(sample length) per symbol wins: its sample needs the
fewest normalised phrases to spell the text.

Texts become symbols (lower-case letters, and one mark for everything between
words); all languages and many stretches of text are parsed at once as arrays.
Stretches of ``STRETCH`` symbols are parsed on their own, so that a very long
text is no longer a chain of steps; every text is parsed whole.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedback_spark.llm.common import python_ready
from feedback_spark.llm.pretokens import worker_state

#: The labelled sample: documents of a language at most, characters of each, symbols of a language.
DOCS_A_LANG, CHARS_A_DOC, SYMBOLS_A_LANG = 96, 2000, 32_768
#: Cells (4 bytes each) up to which all automata are one dense table; beyond, their transitions are hashed.
CELLS = 24_000_000
#: Symbols parsed on their own, and symbols of a batch.
STRETCH, BATCH_SYMBOLS = 2048, 4_000_000
UNKNOWN = "und"
GAP, OTHER = 0, 1  # symbols: between words; a letter the sample has not


def letters_of(text: str) -> str:
    return "".join(c if c.isalpha() else " " for c in text.lower())


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    move: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in move[p]:
            move[p][c] = new
            p = link[p]
        if p != -1:
            q = move[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(move)
                move.append(dict(move[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and move[p].get(c) == q:
                    move[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return move


class Sparse:
    """Transitions (key >= 0, next state) in an open-addressing hash table of 64-bit keys."""

    def __init__(self, keys, values):
        import numpy as np

        bits = max(4, int(2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slots = self.first(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == -1)
            at, one = np.unique(slots[free], return_index=True)  # one newcomer a free slot
            self.keys[at], self.values[at] = keys[free[one]], values[free[one]]
            left = self.keys[slots] != keys
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask

    def first(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys, default):
        """Next state of each key, ``default`` where there is none."""
        import numpy as np

        slots, out = self.first(keys), default.copy()
        left = np.arange(len(keys))
        while len(left):
            seen = self.keys[slots]
            hit = seen == keys
            out[left[hit]] = self.values[slots[hit]]
            more = ~hit & (seen != -1)
            left, keys, slots = left[more], keys[more], (slots[more] + 1) & self.mask
        return out


class Parser:
    """All languages' automata in one table: next state, or its complement where the symbol begins a phrase.

    The table is dense up to ``CELLS`` cells, else hashed (an automaton of n
    symbols has 3 n transitions at most, whatever the alphabet).
    """

    def __init__(self, spec: dict):
        import numpy as np

        self.langs: list[str] = spec["langs"]
        self.letters = {c: i + 2 for i, c in enumerate(spec["letters"])}
        self.width = len(self.letters) + 2
        kind = np.dtype(spec.get("symbol", "u1"))
        sequences = [np.frombuffer(zlib.decompress(base64.b64decode(s)), kind).tolist() for s in spec["sequences"]]
        self.bits = np.array([math.log2(len(s) + 1) for s in sequences])
        moves = [automaton(s) for s in sequences]
        self.roots = np.concatenate([[0], np.cumsum([len(m) for m in moves])])[:-1].astype(np.int32)
        states = sum(map(len, moves))
        self.starts = np.repeat(~self.roots[:, None], self.width, axis=1)
        keys, values = [], []
        for i, (root, move) in enumerate(zip(self.roots.tolist(), moves, strict=True)):
            for c, to in move[0].items():
                self.starts[i, c] = ~(root + to)
            for s, out in enumerate(move):
                for c, to in out.items() if s else ():  # from the root every symbol begins a phrase
                    keys.append((root + s) * self.width + c)
                    values.append(root + to)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        self.table = self.sparse = None
        if states * self.width <= CELLS:
            self.table = np.repeat(self.starts, [len(m) for m in moves], axis=0).ravel()
            self.table[keys] = values
        else:
            self.sparse = Sparse(keys, values)
        points = np.zeros(0x110000, kind)
        for p in range(0x110000):
            if not 0xD800 <= p < 0xE000 and (c := chr(p)).isalpha():
                points[p] = self.letters.get(c, OTHER)
        self.points = points

    def symbols(self, text: str):
        """Symbols of a text, without leading, trailing or repeated gaps."""
        import numpy as np

        s = self.points[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)]
        keep = s != GAP
        keep[1:] |= s[:-1] != GAP
        s = s[keep]
        return s[1 if len(s) and s[0] == GAP else 0:len(s) - 1 if len(s) > 1 and s[-1] == GAP else len(s)]

    def phrases(self, texts: list):
        """Phrases of each text (array of symbols) in each language: one row a text."""
        import numpy as np

        owner, parts = [], []
        for i, s in enumerate(texts):
            for k in range(0, len(s), STRETCH):
                owner.append(i)
                parts.append(s[k:k + STRETCH])
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if not parts:
            return out
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        lengths = np.array([len(parts[i]) for i in order])
        grid = np.zeros((lengths[0], len(parts)), self.points.dtype)
        for col, i in enumerate(order):
            grid[:len(parts[i]), col] = parts[i]
        n = len(self.langs)
        state = np.repeat(self.roots[:, None], len(parts), axis=1)
        begun = np.zeros((n, len(parts)), np.int32)
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # stretches longer than the step
        for step in range(lengths[0]):
            m = active[step]
            if self.sparse:
                key = state[:, :m].astype(np.int64) * self.width + grid[step, :m]
                got = self.sparse.get(key.ravel(), self.starts[:, grid[step, :m]].ravel()).reshape(n, m)
            else:
                got = self.table[state[:, :m] * self.width + grid[step, :m]]
            sign = got >> 31
            begun[:, :m] -= sign
            state[:, :m] = got ^ sign
        np.add.at(out, np.array(owner)[order], begun.T)
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        import numpy as np

        coded = [self.symbols(t or "") for t in texts]
        langs, scores = [], []
        at = 0
        while at < len(coded):
            upto, size = at, 0
            while upto < len(coded) and (size == 0 or size + len(coded[upto]) <= BATCH_SYMBOLS):
                size += len(coded[upto])
                upto += 1
            cost = self.phrases(coded[at:upto]) * self.bits
            for s, row in zip(coded[at:upto], cost, strict=True):
                if not len(s) or not len(row):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmin(row))  # ties: the first language by name
                langs.append(self.langs[best])
                scores.append(float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum()))
            at = upto
        return langs, scores


def fit(docs: DataFrame, docs_a_lang: int = DOCS_A_LANG, chars_a_doc: int = CHARS_A_DOC, symbols_a_lang: int = SYMBOLS_A_LANG) -> dict:
    """Sample sequences and letters from ``docs`` (doc_id, text, lang): of each language the first documents in hash order."""
    import numpy as np

    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ids = known.select("doc_id", "lang").withColumn("h", F.xxhash64("doc_id")).withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id")))
    ids = ids.where(F.col("place") <= docs_a_lang).select("doc_id", "lang", "place")  # the rank limit runs in each task before the shuffle
    picked = known.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), ["doc_id", "lang"])  # docs_a_lang ids of each language
    rows = picked.select("lang", "place", F.substring("text", 1, chars_a_doc).alias("text")).distinct().collect()
    by: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"], r["text"])):
        by.setdefault(r["lang"], []).append(" ".join(letters_of(r["text"]).split()))
    by = {lang: texts for lang, texts in by.items() if any(texts)}
    letters = [c for c, _ in sorted(Counter("".join("".join(t) for t in by.values()).replace(" ", "")).items(), key=lambda x: (-x[1], x[0]))]
    place = {c: i + 2 for i, c in enumerate(letters)}
    kind = "u1" if len(letters) + 2 <= 256 else "<u4"
    sequences = []
    for texts in by.values():
        s = np.array([GAP if c == " " else place[c] for c in " ".join(t for t in texts if t)[:symbols_a_lang]], kind).tobytes()
        sequences.append(base64.b64encode(zlib.compress(s)).decode())
    return {"langs": list(by), "letters": "".join(letters), "symbol": kind, "sequences": sequences}


def identify(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: ``keep`` columns, ``lang_pred`` and ``score`` (0 to 1).

    A text that is null or has no letter, or a model without languages, gives
    ``und`` and 0; equal costs go to the first language by name; repeated rows
    are judged each; an empty table gives no rows; columns not kept play no part.
    """
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(json.dumps(model))
    key = f"language:{zlib.crc32(sent.value.encode())}"

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parser = worker_state(key, lambda: Parser(json.loads(sent.value)))
        for b in batches:
            langs, scores = parser.judge(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             schema=pa.schema([*list(b.schema)[:-1], pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]))

    kept = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["lang_pred string, score double"])
    return kept.mapInArrow(judge, schema)
