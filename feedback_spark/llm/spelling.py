"""Spelling variants: blocked Gram matrices of letter counts, then verified edits.

1. Words are counted with a map-side combine; only the counted vocabulary goes on.
2. A word's cell is its letters' totals in ``GROUPS`` letter groups (their sum is
   its length).  One edit leaves the cell, moves one letter between two groups or
   adds one to a group, so near words lie in the same cell or in one of a fixed
   number of neighbour cells, of equal or adjacent length.
3. A cell's words are dealt by hash over tiles of about ``TILE`` words; a pair of
   tiles is one unit of work, so a crowded cell spreads over many tasks.
4. Per unit a NumPy product of the tiles' letter-count matrices gives all squared
   distances |x|² + |y|² - 2xy; one edit changes them by at most two.  Pairs at
   most two apart are verified letter by letter, and only those leave the task.
5. Forms come from one aggregate per word, roots by pointer doubling (a form is at
   least twice as frequent, so chains are short).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import materialise, python_ready

#: Letter groups of a cell, words of a tile, code points of a tile (long words share smaller tiles).
GROUPS, TILE, TILE_POINTS = 6, 1024, 1 << 20
#: Columns of a letter-count matrix: code points are folded to these, which never parts near words.
COLUMNS = 128
#: Least length and number of occurrences of a word, and the factor by which a form must be more frequent.
LEAST_LENGTH, LEAST_COUNT, FACTOR = 5, 3, 2
# The runs that are words, and the share of (document, run) pairs that lose a letter.
RUN = r"[A-Za-zÀ-ÿ]+"
NOISE = 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(doc_id: Column, run: Column) -> Column:
    """``run`` without the letter that the hash of (doc_id, run) picks, where ``NOISE`` divides the hash."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    return F.when(F.pmod(h, F.lit(NOISE)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n`` of all words of the texts that are long and frequent enough.

    A null text has no words; under a null id no run loses a letter; repeated
    rows count each.
    """
    runs = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run")).select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def cell_of(word: Column) -> Column:
    """Number of letters in each letter group (code point modulo ``GROUPS``)."""
    groups = F.transform(F.split(word, ""), lambda c: F.ascii(c) % GROUPS)
    return F.transform(F.array(*[F.lit(g) for g in range(GROUPS)]), lambda g: F.size(F.filter(groups, lambda x: x == g)))


def neighbour_cells(cell: Column) -> Column:
    """The cell itself (kind 0), each with a letter moved to a later group (1), each with one letter more (2)."""
    def moved(down: int | None, up: int | None) -> Column:
        return F.transform(cell, lambda x, i: x + F.when(i == F.lit(up), 1).otherwise(0) - F.when(i == F.lit(-1 if down is None else down), 1).otherwise(0))

    pick = [F.struct(F.lit(0).alias("kind"), cell.alias("cell"))]
    pick += [F.struct(F.lit(1).alias("kind"), moved(a, b).alias("cell")) for a in range(GROUPS) for b in range(a + 1, GROUPS)]
    pick += [F.struct(F.lit(2).alias("kind"), moved(None, b).alias("cell")) for b in range(GROUPS)]
    return F.filter(F.array(*pick), lambda c: F.array_min(c["cell"]) >= 0)


def tiles(words: DataFrame, tile: int = TILE) -> DataFrame:
    """cell, tile and the tile's words (one per line) with their counts."""
    placed = words.withColumn("cell", cell_of(F.col("word")))
    room = F.greatest(F.lit(1), F.least(F.lit(tile), F.lit(TILE_POINTS) / F.greatest(F.lit(1), F.length("word")))).cast("int")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.min(room)).alias("n_tiles"))
    dealt = placed.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("n_tiles")).cast("int"))
    held = dealt.groupBy("cell", "tile").agg(F.collect_list(F.struct("word", "n")).alias("held"))
    return held.select("cell", "tile", F.array_join(F.transform("held", lambda x: x["word"]), "\n").alias("words"), F.transform("held", lambda x: x["n"]).alias("ns"))


def letters(words: str):
    """Code points of a tile's words (all of one length), a row each."""
    import numpy as np

    points = np.frombuffer((words + "\n").encode("utf-32-le"), np.uint32)
    return points.reshape(-1, len(words.split("\n", 1)[0]) + 1)[:, :-1]


def letter_counts(points):
    """Folded letter counts, a row per word; exact in the type chosen."""
    import numpy as np

    n, length = points.shape
    at = (np.arange(n)[:, None] * COLUMNS + points % COLUMNS).ravel()
    return np.bincount(at, minlength=n * COLUMNS).reshape(n, COLUMNS).astype(np.float32 if length < 2000 else np.float64)


def one_edit(x, y):
    """For rows of code points, x as long as y or one shorter: whether one replaced, or one inserted, parts them."""
    import numpy as np

    length = x.shape[1]
    if y.shape[1] == length:
        return (x != y).sum(1) == 1
    head = np.minimum.accumulate(x == y[:, :-1], axis=1).sum(1)
    tail = np.minimum.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= length


def near_pairs(x, y, same: bool):
    """Index pairs of two tiles' words that one edit parts (``same``: within one tile, each pair once)."""
    import numpy as np

    cx, cy = letter_counts(x), letter_counts(y)
    apart = (cx * cx).sum(1)[:, None] + (cy * cy).sum(1)[None, :] - 2 * (cx @ cy.T)
    i, j = np.nonzero(apart <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    good = one_edit(x[i], y[j])
    return i[good], j[good]


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word``, ``near``, ``near_n``: each pair of distinct words one edit apart, from both sides.

    ``words``: word (distinct, without line breaks) and n.
    """
    python_ready(words.sparkSession)

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tile_letters = lru_cache(64)(letters)
        for b in batches:
            found: list = []
            kind, tile_a, tile_b = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for r in range(b.num_rows):
                a, c = b.column(3)[r].as_py(), b.column(4)[r].as_py()
                i, j = near_pairs(tile_letters(a), tile_letters(c), kind[r] == 0 and tile_a[r] == tile_b[r])
                if len(i):
                    wa, wc = np.array(a.split("\n"), object)[i], np.array(c.split("\n"), object)[j]
                    na, nc = b.column(5)[r].values.to_numpy()[i], b.column(6)[r].values.to_numpy()[j]
                    found += [(wa, wc, nc), (wc, wa, na)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*found, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], ["word", "near", "near_n"])

    held = materialise(tiles(words, tile), "tiles")
    left = held.select(F.col("tile").alias("tile_a"), F.col("words").alias("words_a"), F.col("ns").alias("ns_a"), F.inline(neighbour_cells(F.col("cell"))))
    right = held.select("cell", F.col("tile").alias("tile_b"), F.col("words").alias("words_b"), F.col("ns").alias("ns_b"))
    units = left.join(right, "cell").where((F.col("kind") != 0) | (F.col("tile_a") <= F.col("tile_b")))
    return units.select("kind", "tile_a", "tile_b", "words_a", "words_b", "ns_a", "ns_b").mapInArrow(search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form (no circles): pointer doubling until no root has a form."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("to"))
        jumped = materialise(at.join(onward, "root", "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        at = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return at


def group_variants(words: DataFrame, factor: int = FACTOR, tile: int = TILE) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``words``: word (distinct) and n; other columns are left out.  The form is
    the near word of largest n (ties: the first in code-point order) if that n
    is at least ``factor`` (over 1) times the word's; the root is the last of the chain of
    forms, the word itself if it has none.  An empty table gives no rows.
    """
    known = materialise(words.select("word", "n"), "words")
    best = near_words(known, tile).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    joined = known.join(best, "word", "left")
    good = F.coalesce(-F.col("best.n") >= factor * F.col("n"), F.lit(False))
    out = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.n")).alias("form_n")), "forms")
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The variant groups of all words of ``docs`` (columns of ``group_variants``).

    Null and empty texts have no words, very long texts are read whole,
    repeated rows count each, an empty table gives no rows, other columns of
    ``docs`` are never read.
    """
    return group_variants(word_counts(docs, text, doc_id))
