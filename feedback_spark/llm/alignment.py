"""Cross-tokenizer alignment as an associative fragment monoid.

Byte offsets at which tokens of both tokenizers end cut a document's tokens into
groups.  What a byte range sees of that is a *fragment*: the tokens up to the first
common end (open prefix), the groups between common ends (closed), and the tokens
after the last (open suffix).  Fragments of neighbouring ranges compose: a suffix and
the next prefix close into one group.  Composition is associative, so a long
document's ranges are worked on in different tasks and folded in a tree.

A range may cut a token: its task encodes the range with the few characters around
it up to where both tokenizers are sure to start anew (a white-space run after other
text), and keeps the tokens that end inside the range.  A stretch without such a
place that is longer than a range is never cut.

Most documents are one range.  Stretches between such places repeat a lot, so a
worker numbers them, aligns those that are new to it together, and gathers the
documents' tokens by number; the numbered set is bounded.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress, pairwise
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, python_ready
from feedback_spark.llm.pretokens import read_file, tokenizer_of, worker_state

#: Bytes of a range, and how many neighbours one task of the tree folds.
RANGE_BYTES, FAN_IN = 65_536, 8
#: Stretches that a worker keeps, characters of new ones that are encoded together, bytes of documents aligned together.
MOST_KEPT, LEARN_BYTES, DOC_BYTES = 60_000, 65_536, 200_000
# Fixed value: how byte-level tokenizers files cut a text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows of an Arrow batch (a row of the aligned table is some six times its text), bytes of packed ids worked on at once.
BATCH_ROWS = 400
BLOCK_BYTES = 1_000_000
#: Pairs of a group beyond which equal ids are taken together before they are paired.
WIDE_GROUP = 256
#: Largest table of id pairs that is broadcast (12 bytes each); a larger one is joined.
MOST_BROADCAST = 4_000_000


class Fragment(NamedTuple):
    """Ids in order; ``lens``: tokens of each closed group.  Without a common end all is prefix."""

    closed: bool
    prefix: tuple[list[int], list[int]]
    ids: tuple[list[int], list[int]]
    lens: tuple[list[int], list[int]]
    suffix: tuple[list[int], list[int]]


EMPTY = Fragment(False, ([], []), ([], []), ([], []), ([], []))


def fragment(ids: tuple[list[int], list[int]], ends: tuple[list[int], list[int]]) -> Fragment:
    """The fragment of the tokens of a byte range, given where each ends."""
    shared = set(ends[0]).intersection(ends[1])
    if not shared:
        return EMPTY._replace(prefix=(list(ids[0]), list(ids[1])))
    prefix, closed, lens, suffix = [], [], [], []
    for one, at in zip(ids, ends, strict=True):
        cuts = [k + 1 for k, e in enumerate(at) if e in shared and (k + 1 == len(at) or at[k + 1] != e)]
        prefix.append(list(one[:cuts[0]]))
        closed.append(list(one[cuts[0]:cuts[-1]]))
        lens.append([b - a for a, b in zip(cuts, cuts[1:], strict=False)])
        suffix.append(list(one[cuts[-1]:]))
    return Fragment(True, tuple(prefix), tuple(closed), tuple(lens), tuple(suffix))


def compose(f: Fragment, g: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges together."""
    if not f.closed:
        return g._replace(prefix=tuple(f.prefix[k] + g.prefix[k] for k in (0, 1)))
    if not g.closed:
        return f._replace(suffix=tuple(f.suffix[k] + g.prefix[k] for k in (0, 1)))
    mid = [f.suffix[k] + g.prefix[k] for k in (0, 1)]
    return Fragment(True, f.prefix, tuple(f.ids[k] + mid[k] + g.ids[k] for k in (0, 1)),
                    tuple(f.lens[k] + [len(mid[k])] + g.lens[k] for k in (0, 1)), g.suffix)


def folded(fragments: list[Fragment]) -> Fragment:
    """Balanced composition, in order."""
    while len(fragments) > 1:
        fragments = [compose(*fragments[k:k + 2]) if k + 1 < len(fragments) else fragments[k] for k in range(0, len(fragments), 2)]
    return fragments[0] if fragments else EMPTY


def groups_of(whole: Fragment) -> tuple[tuple[list[int], list[int]], tuple[list[int], list[int]]]:
    """Ids and group lengths of a whole document, whose start and end are common."""
    if not whole.closed:
        return ([], []), ([], [])
    return tuple(whole.prefix[k] + whole.ids[k] for k in (0, 1)), tuple([len(whole.prefix[k])] + whole.lens[k] for k in (0, 1))


def group_texts(ids, lens, groups) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each of several documents: all ids and group lengths of both sides, documents' numbers of groups."""
    import numpy as np

    ids, lens = [np.asarray(x, np.int64) for x in ids], [np.asarray(x, np.int64) for x in lens]
    to = [np.cumsum(x) for x in lens]
    end_a, end_b = to[0] + to[1] - lens[1], to[0] + to[1]  # of a group's two sides, among the tokens of both
    flat = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    flat[np.arange(len(ids[0])) + np.repeat(to[1] - lens[1], lens[0])] = ids[0]
    flat[np.arange(len(ids[1])) + np.repeat(to[0], lens[1])] = ids[1]
    width = len(str(int(flat.max(initial=0))))
    said = np.full((len(flat), width + 1), ord(","), np.uint8)
    shown = np.ones(said.shape, bool)
    for k in range(width):
        said[:, width - 1 - k] = flat // 10**k % 10 + ord("0")
        if k:
            shown[:, width - 1 - k] = flat >= 10**k
    said[end_a - 1, width] = ord("|")
    said[end_b - 1, width] = ord(";")
    last = np.concatenate([[0], end_b])[np.cumsum(np.asarray(groups, np.int64))]  # of each document
    shown[last[np.diff(last, prepend=0) > 0] - 1, width] = False
    at = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])[np.concatenate([[0], last])].tolist()
    raw = said[shown].tobytes().decode()
    return [raw[a:b] for a, b in pairwise(at)]


def as_text(ids: tuple[list[int], list[int]], lens: tuple[list[int], list[int]]) -> str:
    """The groups of one document, in order."""
    return group_texts(ids, lens, [len(lens[0])])[0]


class Pair:
    """Both tokenizers, and the aligned tokens of stretches."""

    def __init__(self, a_spec: str, b_model: bytes):
        import sentencepiece

        self.spec, self.library = a_spec, tokenizer_of(a_spec)
        letters = byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.fast, self.latin = ranked(a_spec, self.a_bytes), re.compile("[\0-\u024f]*\\Z")
        self.library = None  # 40 MB that Latin text does not need
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        # white space before which both tokenizers start anew after other text: no piece holds it behind another character
        crossed = {" ": any(re.search("[^▁]▁", p) for p in plain)} | {c: any(c in p for p in plain if len(p) > 1) for c in "\n\t\r"}
        self.starts = "".join(c for c, no in crossed.items() if not no)
        rest = rf"(?:[^\S{re.escape(self.starts)}]\s*\S*)*"  # white space that is no such place, and what follows
        self.part = re.compile(rf"\s*\S+{rest}|\s+") if self.starts else None
        self.spell = [np_bytes(x) for x in ([self.a_bytes[i] for i in range(len(self.a_bytes))], self.b_bytes)]
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.good: list[bool] = []
        self.parts: list[list] = [[], [], [], []]  # ids and lens of both, stretch after stretch
        self.sizes: list[list] = [[], [], [], []]

    def stretches(self, text: str) -> list[str]:
        """``text`` (with its first blank) cut at white-space runs that follow other text."""
        if not self.part:
            return [text]
        if " " in self.starts and text.startswith(" ") and (words := text.split()) == text[1:].split(" "):
            return [" " + w for w in words]
        return self.part.findall(text) or [text]

    def by_library(self, text: str) -> list[int]:
        if self.library is None:
            self.library = tokenizer_of(self.spec)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def tokens(self, text: str) -> tuple[tuple[list[int], list[int]], tuple, bool]:
        """Ids and end offsets of both for one or more whole stretches, from their start; whether both spell the text.

        A letter before the text takes the blank that the second tokenizer adds; its tokens end where the text starts.
        """
        import numpy as np

        raw, ids, ends, good = b" a" + text.encode(), [], [], True
        a = self.fast.encode_ordinary(" a" + text) if self.fast and self.latin.match(text) else self.by_library(" a" + text)
        for one, (lens, spelled) in zip((a, self.b.encode("a" + text)), self.spell, strict=True):
            at = np.cumsum(lens[one])
            k = int(np.searchsorted(at, 2)) + 1
            good &= k <= len(at) and at[k - 1] == 2 and b"".join([spelled[i] for i in one]) == raw
            ids.append(one[k:])
            ends.append(at[k:] - 2)
        return tuple(ids), tuple(ends), bool(good)

    def learn(self, new: list[str]) -> None:
        """Number the stretches, all new: together where they can stand side by side, else one by one."""
        held, size = [], 0
        latin = [s.isascii() or self.latin.match(s) is not None for s in new]
        for s in chain(compress(new, latin), (s for s, fast in zip(new, latin, strict=True) if not fast)):  # Latin letters first: they take the faster way
            if s[-1].isspace():  # it would run into the next
                self.add([s])
                continue
            held.append(s)
            size += len(s)
            if size >= LEARN_BYTES:
                self.add(held)
                held, size = [], 0
        if held:
            self.add(held)

    def add(self, held: list[str]) -> None:
        import numpy as np

        ids, ends, good = self.tokens("".join(held))
        to = np.cumsum([len(s.encode()) for s in held])
        common = np.intersect1d(*ends, assume_unique=True)
        at = np.searchsorted(common, to)
        whole = good and len(common) > 0 and at[-1] < len(common) and bool((common[at] == to).all())
        if not whole and len(held) > 1:
            for s in held:
                self.add([s])
            return
        if not whole:
            ids, lens = ([], []), ([], [])
            sizes = [np.zeros(1, np.int64)] * 4
        else:
            cuts = [np.searchsorted(e, common) + 1 for e in ends]
            lens = tuple(np.diff(c, prepend=0) for c in cuts)
            groups = np.diff(at + 1, prepend=0)
            sizes = [np.diff(c[at], prepend=0) for c in cuts] + [groups, groups]
        for k, x in enumerate((*ids, *lens)):
            self.parts[k].append(np.asarray(x, "<u4"))
            self.sizes[k].append(sizes[k])
        self.codes.update(zip(held, range(len(self.good), len(self.good) + len(held)), strict=True))
        self.good += [whole] * len(held)

    def aligned(self, docs: list[str | None]) -> list[tuple[bytes, bytes, bytes, bytes, str]]:
        """Packed ids and group lengths, and the groups as text, of whole texts (None: no tokens)."""
        import numpy as np

        cut = [self.stretches(t) if t else [] for t in docs]
        if len(self.codes) > MOST_KEPT:
            self.forget()
        self.learn([s for s in dict.fromkeys(chain.from_iterable(cut)) if s not in self.codes])
        codes = [list(map(self.codes.__getitem__, parts)) for parts in cut]
        fine = [bool(c) and all(map(self.good.__getitem__, c)) for c in codes]
        codes = [c if ok else [] for c, ok in zip(codes, fine, strict=True)]
        flat = np.fromiter(chain.from_iterable(codes), np.int64)
        n = np.array([len(c) for c in codes])
        sides, whole = [], []
        for k in range(4):
            values = np.concatenate([*self.parts[k], np.zeros(0, "<u4")])
            size = np.concatenate([*self.sizes[k], np.zeros(0, np.int64)])
            self.parts[k], self.sizes[k] = [values], [size]
            starts, own = np.cumsum(size) - size, size[flat]
            out = values[np.repeat(starts[flat] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
            ends = np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(n)])]
            raw = out.tobytes()
            sides.append([raw[a:b] for a, b in pairwise((ends * 4).tolist())])
            whole.append(out)
        return list(zip(*sides, group_texts(whole[:2], whole[2:], np.diff(ends)), strict=True))


def ranked(spec: str, spelled: dict[int, bytes]):
    """The byte-level tokenizer as a table of ranks (quicker; its letter classes may be of another age, so it gets Latin text only); None if it is of another kind."""
    import json

    import tiktoken

    d = json.loads(spec)
    vocab, merges = d["model"]["vocab"], [x.split(" ") if isinstance(x, str) else x for x in d["model"].get("merges", [])]
    first = len(vocab) - len(merges)
    if d["normalizer"] or (d["pre_tokenizer"] or {}).get("type") != "ByteLevel" or not d["pre_tokenizer"]["use_regex"] or d["pre_tokenizer"]["add_prefix_space"]:
        return None
    if first != 256 or d["model"].get("end_of_word_suffix") or d["model"].get("continuing_subword_prefix") or any(vocab.get(a + b) != first + k for k, (a, b) in enumerate(merges)):
        return None
    return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks={spelled[i]: i for i in vocab.values()}, special_tokens={})


def np_bytes(spelled: list[bytes]):
    """Lengths of the tokens' bytes as an array, and the bytes."""
    import numpy as np

    return np.array([len(x) for x in spelled]), spelled


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def packed(values: list[int]) -> bytes:
    import numpy as np

    return np.array(values, "<u4").tobytes()


def unpacked(values: bytes) -> list[int]:
    import numpy as np

    return np.frombuffer(values, "<u4").tolist()


def decoded(raw: bytes | None) -> str | None:
    """The text with its first blank; None where there are no tokens."""
    try:
        return " " + raw.decode() if raw else None
    except UnicodeDecodeError:
        return None


SIDES = ("a_ids", "b_ids", "a_lens", "b_lens")
FOLDS = ("prefix_a", "prefix_b", "ids_a", "ids_b", "lens_a", "lens_b", "suffix_a", "suffix_b")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), range_bytes: int = RANGE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: ``keep`` columns, ``row`` (an id of the row), ``a_ids``, ``b_ids``, ``a_lens``, ``b_lens``, ``groups``.

    Ids are binary, little-endian unsigned 32-bit integers: of space + text by
    the byte-level tokenizer ``a_path`` and of text by the sentencepiece model
    ``b_path``, special strings as plain text.  The lens are each group's
    number of tokens, ``groups`` the groups as text.  All are empty for a null
    or empty text and where the tokens do not spell space + text.  Repeated
    rows are aligned each; an empty table gives no rows; other columns,
    whatever their names, are left out.
    """
    spark = docs.sparkSession
    python_ready(spark, BATCH_ROWS)
    with open(b_path, "rb") as f:
        model = f.read()
    sent = spark.sparkContext.broadcast((read_file(a_path), model))
    key = f"align:{zlib.crc32(sent.value[0].encode())}:{zlib.crc32(model)}"

    def pair() -> Pair:
        return worker_state(key, lambda: Pair(*sent.value))

    def whole(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p = pair()
        for b in batches:
            texts, at, size = [decoded(raw) for raw in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()], 0, 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size < DOC_BYTES and k + 1 < len(texts):
                    continue
                out, head = p.aligned(texts[at:k + 1]), b.slice(at, k + 1 - at)
                mark = uuid.uuid4().hex
                rows = pa.array([f"{mark}-{i}" for i in range(len(out))])
                cols = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.binary()] * 4 + [pa.string()], strict=True)]
                yield pa.RecordBatch.from_arrays([*head.columns[:-1], rows, *cols], schema=pa.schema([*list(b.schema)[:-1], pa.field("row", pa.string()), *[pa.field(n, c.type) for n, c in zip((*SIDES, "groups"), cols, strict=True)]]))
                at, size = k + 1, 0
        p.forget()  # idle workers hold no stretches

    def cut(batches: Iterator) -> Iterator:
        """Byte ranges (lo, hi] of space + text, each with the whole stretches that it touches."""
        import pyarrow as pa

        p = pair()
        for b in batches:
            for row, raw in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                t = decoded(raw)
                if t is None:
                    continue
                parts = [s.encode() for s in p.stretches(t)]
                starts, at = [], 0
                for s in parts:
                    starts.append(at)
                    at += len(s)
                cuts, k = [0], 0
                for want in range(range_bytes, at, range_bytes):
                    while k + 1 < len(parts) and starts[k + 1] <= want:
                        k += 1
                    place = want if len(parts[k]) <= range_bytes else starts[k] + len(parts[k])
                    if cuts[-1] < place < at:
                        cuts.append(place)
                cuts.append(at)
                out, k = [], 0
                for n, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    while k + 1 < len(parts) and starts[k + 1] <= lo:
                        k += 1
                    to = k
                    while to < len(parts) and starts[to] < hi:
                        to += 1
                    out.append((row, n, starts[k], lo, hi, b"".join(parts[k:to])))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["row", "n", "start", "lo", "hi", "body"])

    def leaf(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p = pair()
        for b in batches:
            out = []
            for row, n, at, lo, hi, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids, ends, good = p.tokens(body.decode())
                own = [[(i, e) for i, e in zip(x, (to + at).tolist(), strict=True) if lo < e <= hi] for x, to in zip(ids, ends, strict=True)]
                kept = [tuple([x[k] for x in side] for side in own) for k in (0, 1)]
                out.append((row, n, good, *packed_fragment(fragment(*kept) if good else EMPTY)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.binary()] * 8], strict=True)], ["row", "n", "good", "closed", *FOLDS])

    def fold(held):
        import pyarrow as pa

        held = held.sort_by("n")
        parts = [unpacked_fragment(x) for x in zip(*(held.column(c).to_pylist() for c in ("closed", *FOLDS)), strict=True)]
        good = all(held.column("good").to_pylist())
        out = packed_fragment(folded(parts) if good else EMPTY)
        head = [held.column("row").to_pylist()[0], held.column("n").to_pylist()[0] // fan_in, good]
        return pa.table({c: pa.array([v], t) for c, v, t in zip(["row", "n", "good", "closed", *FOLDS], [*head, *out], [pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.binary()] * 8], strict=True)})

    def ended(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = []
            for row, _, _, *x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids, lens = groups_of(unpacked_fragment(x))
                out.append((row, *map(packed, (*ids, *lens)), as_text(ids, lens)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64(), *[pa.binary()] * 4, pa.string()], strict=True)], ["n", *SIDES, "groups"])

    kept = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).toDF(*[f"c{i}" for i in range(len(keep))], "text")
    head = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields[:-1]))
    short = kept.where(F.octet_length("text") < range_bytes).mapInArrow(whole, f"{head}, row string, a_ids binary, b_ids binary, a_lens binary, b_lens binary, groups string")
    long = materialise(kept.where(F.octet_length("text") >= range_bytes).withColumn("n", F.monotonically_increasing_id()), "long")
    ranges = materialise(long.select("n", "text").mapInArrow(cut, "row long, n int, start long, lo long, hi long, body binary"), "ranges")
    shape = "row long, n int, good boolean, closed boolean, " + ", ".join(f"{c} binary" for c in FOLDS)
    level = ranges.repartition("row", "n").mapInArrow(leaf, shape)
    most = ranges.agg(F.max("n")).first()[0] or 0
    while most:
        level = level.groupBy("row", F.floor(F.col("n") / fan_in)).applyInArrow(fold, shape)
        most //= fan_in
    done = level.mapInArrow(ended, "n long, a_ids binary, b_ids binary, a_lens binary, b_lens binary, groups string")
    empty = [F.coalesce(c, F.lit("").cast("binary")).alias(c) for c in SIDES]
    far = long.drop("text").join(done, "n", "left").select(*[f"c{i}" for i in range(len(keep))], F.concat(F.lit("long-"), F.col("n").cast("string")).alias("row"), *empty, F.coalesce("groups", F.lit("")).alias("groups"))
    return short.unionByName(far).toDF(*keep, "row", *SIDES, "groups")


def packed_fragment(f: Fragment) -> tuple:
    return (f.closed, *[packed(x) for part in (f.prefix, f.ids, f.lens, f.suffix) for x in part])


def unpacked_fragment(x) -> Fragment:
    v = [unpacked(y) for y in x[1:]]
    return Fragment(x[0], (v[0], v[1]), (v[2], v[3]), (v[4], v[5]), (v[6], v[7]))


def links(docs: list[tuple[bytes, bytes, bytes, bytes]]):
    """Of a block of documents: (document, a, b, times) of every linked id pair, pairs distinct within a document.

    All pairs of a group's occurrences; in a wide group equal ids are taken
    together first, so its pairs are of distinct ids.
    """
    import numpy as np

    sides = [[np.frombuffer(d[k], "<u4").astype(np.int64) for d in docs] for k in range(4)]
    a, b, na, nb = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in sides)
    doc = np.repeat(np.arange(len(docs)), [len(x) for x in sides[2]])
    at_a, at_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    wide = na * nb > WIDE_GROUP
    g = np.flatnonzero(~wide)
    size = (na * nb)[g]
    of = np.repeat(g, size)
    k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    parts = [(doc[of], a[at_a[of] + k // nb[of]], b[at_b[of] + k % nb[of]], np.ones(len(of), np.int64))]
    for g in np.flatnonzero(wide):
        x, nx = np.unique(a[at_a[g]:at_a[g] + na[g]], return_counts=True)
        y, ny = np.unique(b[at_b[g]:at_b[g] + nb[g]], return_counts=True)
        parts.append((np.full(len(x) * len(y), doc[g]), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(nx, ny).ravel()))
    d, a, b, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    bits_a, bits_b = max(1, int(a.max(initial=0)).bit_length()), max(1, int(b.max(initial=0)).bit_length())
    if len(docs).bit_length() + bits_a + bits_b <= 62:  # one sortable number
        key, at = np.unique((d << (bits_a + bits_b)) | (a << bits_b) | b, return_inverse=True)
        d, a, b = key >> (bits_a + bits_b), (key >> bits_b) & ((1 << bits_a) - 1), key & ((1 << bits_b) - 1)
    else:
        rows, at = np.unique(np.stack([d, a, b]), axis=1, return_inverse=True)
        d, a, b = rows
    return d, a, b, np.bincount(at.ravel(), weights=n, minlength=len(d)).astype(np.int64)


def blocks(batches: Iterator) -> Iterator:
    """(batch, rows) in slices of about ``BLOCK_BYTES`` of the packed columns, the last four."""
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in b.columns[-4:]), strict=True))
        at, size = 0, 0
        for k, row in enumerate(rows):
            size += sum(map(len, row))
            if size >= BLOCK_BYTES or k + 1 == len(rows):
                yield b.slice(at, k + 1 - at), rows[at:k + 1]
                at, size = k + 1, 0


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n``: in how many rows of ``aligned`` the id pair is linked; ``best``: no b has more for this a."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for _, rows in blocks(batches):
            _, a, b, _ = links(rows)
            pairs, n = np.unique((a << 32) | b, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    python_ready(aligned.sparkSession, BATCH_ROWS)
    counts = materialise(aligned.select(*SIDES).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n"), "links")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, counts: DataFrame, keep: tuple[str, ...], most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``keep`` columns of ``aligned`` with n_a, n_b, n_groups, n_links, n_best and count_sum.

    ``aligned`` is read more than once, and its ``row`` must stay: pass a written
    table.  Up to ``most_broadcast`` pairs the counts go to the tasks as sorted
    arrays; beyond, each row's distinct pairs are joined with them.
    """
    spark = aligned.sparkSession
    known = materialise(counts, "counts")
    size = lambda c: (F.octet_length(c) / 4).cast("long")
    about = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], size("a_ids").alias("n_a"), size("b_ids").alias("n_b"), size("a_lens").alias("n_groups"))
    told = aligned.select(about.alias("about"), "row", *SIDES)
    kind = told.schema["about"].dataType.simpleString()
    columns = [*[F.col(f"about.c{i}").alias(c) for i, c in enumerate(keep)], "about.n_a", "about.n_b", "about.n_groups", "n_links", "n_best", "count_sum"]
    if known.count() <= most_broadcast:
        import numpy as np

        t = known.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair"), F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("n")).toArrow()
        pairs, n = t.column("pair").to_numpy(), t.column("n").to_numpy()
        order = np.argsort(pairs)
        sent = spark.sparkContext.broadcast((pairs[order], n[order]))

        def score(batches: Iterator) -> Iterator:
            import numpy as np
            import pyarrow as pa

            pairs, n = sent.value
            for b, rows in blocks(batches):
                d, x, y, times = links(rows)
                got = n[np.searchsorted(pairs, (x << 32) | y)] if len(d) else np.zeros(0, np.int64)
                sums = [pa.array(exact_sums(d, v, len(rows))) for v in (times, times * (got < 0), times * np.abs(got))]
                yield pa.RecordBatch.from_arrays([b.column(0), *sums], schema=pa.schema([b.schema.field(0), *[pa.field(c, pa.int64()) for c in ("n_links", "n_best", "count_sum")]]))

        return told.select("about", *SIDES).mapInArrow(score, f"about {kind}, n_links long, n_best long, count_sum long").select(*columns)

    def expand(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b, rows in blocks(batches):
            d, x, y, times = links(rows)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(d)), pa.array(x), pa.array(y), pa.array(times)], ["row", "a", "b", "times"])

    each = aligned.select("row", *SIDES).mapInArrow(expand, "row string, a long, b long, times long").join(known, ["a", "b"])
    sums = each.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return told.select("about", "row").join(sums, "row", "left").fillna(0, ["n_links", "n_best", "count_sum"]).select(*columns)


def exact_sums(of, values, n: int):
    """Integer sums of ``values`` by ``of`` (ascending), for 0 to n - 1."""
    import numpy as np

    total = np.concatenate([[0], np.cumsum(values)])
    at = np.searchsorted(of, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]
