"""Toxicity scores from a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps homoglyphs (Cyrillic, Greek, full width and styled letters, and
accented letters that the labelled texts hardly use) and digit substitutions to
one plain spelling, in texts and lexicon alike, and turns everything else into
single blanks.  The lexicon holds whole words and
word beginnings, each with a log-odds weight learned from labelled documents;
exception phrases (given or learned) void the matches inside them.  The sum of
the weights and the same sum per 100 words go through a fitted logistic curve.

What is fitted: at most ``MOST_TOXIC`` + ``MOST_CLEAN`` labelled documents, in
the order of a hash of their id.  Scoring covers every text whole.
"""

from __future__ import annotations

import json
import math
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark.llm.common import all_columns, free_prefix, materialise, python_ready
from feedback_spark.llm.pretokens import worker_state

#: Bounds of the labelled sample and of the lexicon.
MOST_TOXIC, MOST_CLEAN, MOST_ENTRIES = 8000, 12_000, 5000
#: Least number of document families with an entry; least odds of toxic to clean families.
LEAST_SUPPORT, LEAST_ODDS = 4, 3.0
#: Least share of families among the documents with an entry (copies of one text make one family).
LEAST_VARIETY = 0.25
#: Lengths of word beginnings that may become entries.
STEMS = (4, 5, 6, 7, 8, 9)
#: A letter with at least this share of the labelled texts' letters is an ordinary one and keeps its accent.
ORDINARY = 1e-4
#: Short texts count as this many words when the weights are set against the length.
LEAST_WORDS = 20
#: Phrases in which a lexicon word means no offence.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "stupid simple")

# Characters that look like a Latin letter, and the letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x", "ь": "b", "ӏ": "i", "α": "a", "β": "b", "ε": "e",
    "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ø": "o",
    "ł": "i", "đ": "d", "ħ": "h", "ɑ": "a", "ɡ": "g", "ɩ": "i",
}
# Digits and signs written for a letter; l, i and 1 share one spelling.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}


class Folding(dict):
    """Table for ``str.translate`` that works out each character when it is first met."""

    def __init__(self, alphabet: str = ""):
        super().__init__()
        self.alphabet = frozenset(alphabet)

    def __missing__(self, point: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKC", chr(point)).lower():
            for x in (c,) if c in self.alphabet else unicodedata.normalize("NFKD", c):
                if unicodedata.category(x) in ("Mn", "Cf"):
                    continue
                x = SUBSTITUTES.get(x, x) if x in self.alphabet else SUBSTITUTES.get(y := HOMOGLYPHS.get(x, x), y)
                out += x if x.isalnum() else " "
        self[point] = out
        return out


def fold_text(text: str | None, folding: Folding) -> str:
    """Folded words with single blanks between them."""
    return " ".join((text or "").translate(folding).split())


@dataclass
class Model:
    """Lexicon entries (``"word "`` whole, ``"stem"`` a beginning) with weights, exceptions, ordinary letters and curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    alphabet: str = ""
    curve: list[float] = field(default_factory=lambda: [-20.0, 0.0, 0.0])

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (0.0, len(phrase) + 2))
        for entry, w in self.weights.items():
            a.add_word(f" {entry}", (w, len(entry) + 1))
        if len(a):
            a.make_automaton()
        return a


def matches(automaton, folded: str) -> tuple[float, int]:
    """Sum of the weights of the words matched (the largest of each word), and their number; exceptions void theirs."""
    if not len(automaton) or not folded:
        return 0.0, 0
    found: dict[int, float] = {}
    void: list[tuple[int, int]] = []
    for end, (w, n) in automaton.iter(f" {folded} "):
        start = end - n + 1
        if w:
            found[start] = max(found.get(start, w), w)
        else:
            void.append((start, end))
    for a, b in void:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return math.fsum(found.values()), len(found)


def features(total: float, n_words: int) -> list[float]:
    return [1.0, math.log1p(total), math.log1p(100 * total / max(n_words, LEAST_WORDS))]


def curve_of(rows: list[tuple[int, float, int]], weight: dict[int, float]) -> list[float]:
    """Ridge-regularised logistic fit of the label on ``features`` (Newton's method, bounded rows)."""
    import numpy as np

    x = np.array([features(t, n) for _, t, n in rows])
    y = np.array([float(label) for label, _, _ in rows])
    w = np.array([weight[label] for label, _, _ in rows])
    w, b = w / w.mean(), np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.05, 0.05])
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - np.array([1e-3, 0.05, 0.05]) * b)
        b += step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return b.tolist()


def entries_of(words: set[str]) -> set[str]:
    """Lexicon entries that the words support: each whole, and its beginnings."""
    out = {f"{w} " for w in words}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


class Supported(dict):
    """word -> the wanted entries that it supports, worked out once a word (bounded)."""

    def __init__(self, wanted: frozenset):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= 200_000:
            self.clear()
        self[word] = out = tuple(e for e in entries_of({word}) if e in self.wanted)
        return out


def family(words: list[str]) -> int:
    """Smallest hash of the word 5-grams: copies with small edits mostly share it."""
    from xxhash import xxh64_intdigest

    return min((xxh64_intdigest(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0) >> 1


def labelled_sample(docs: DataFrame, labels: DataFrame, most_toxic: int, most_clean: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts of a bounded sample of the labelled documents (``labels``: doc_id, toxic), and the labels' totals."""
    one = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    one = materialise(one, "labels", rows=labels.count())
    totals = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    ids = None
    for label, most in ((1, most_toxic), (0, most_clean)):
        part = one.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    picked = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")  # at most most_toxic + most_clean ids
    return materialise(picked.select("toxic", "text"), "toxic-sample"), totals


def ordinary_letters(sample: DataFrame) -> str:
    """Letters outside ASCII that make up at least ``ORDINARY`` of the sample's letters."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                n.update(unicodedata.normalize("NFKC", t).lower())
        n = Counter({c: k for c, k in n.items() if c.isalpha()})
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["letter", "n"])

    found = {r["letter"]: r["n"] for r in sample.select("text").mapInArrow(count, "letter string, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()}
    return "".join(sorted(c for c, n in found.items() if n >= ORDINARY * sum(found.values()) and not c.isascii()))


def folded_sample(sample: DataFrame, alphabet: str) -> DataFrame:
    """toxic, folded text, family of copies and number of words of each sampled document."""

    def fold(batches: Iterator) -> Iterator:
        import pyarrow as pa

        folding = Folding(alphabet)
        for b in batches:
            texts = [fold_text(t, folding) for t in b.column("text").to_pylist()]
            words = [t.split() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(texts, pa.string()), pa.array([family(w) for w in words], pa.int64()), pa.array([len(w) for w in words], pa.int64())], ["toxic", "folded", "family", "words"])

    return materialise(sample.mapInArrow(fold, "toxic int, folded string, family long, words long"), "toxic-folded")


def documents_with(sample: DataFrame, label: int, wanted: frozenset | None = None) -> DataFrame:
    """entry, n: sampled documents of the label that hold each entry (added up in each task first)."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n: Counter = Counter()
        supported = None if wanted is None else Supported(wanted)
        for b in batches:
            for t in b.column(0).to_pylist():
                words = set(t.split())
                n.update(entries_of(words) if supported is None else {e for w in words for e in supported[w]})
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["entry", "n"])

    return sample.where(F.col("toxic") == label).select("folded").mapInArrow(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def families_with(sample: DataFrame, wanted: frozenset) -> dict[int, dict[str, tuple[int, int]]]:
    """By label and entry: families that hold the entry, and its occurrences (of each family the most in one document)."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        most: dict = {}
        supported = Supported(wanted)
        for b in batches:
            for label, t, f in zip(*(b.column(c).to_pylist() for c in ("toxic", "folded", "family")), strict=True):
                n: dict = {}
                for w, k in Counter(t.split()).items():
                    for e in supported[w]:
                        n[e] = n.get(e, 0) + k
                for e, k in n.items():
                    most[label, e, f] = max(k, most.get((label, e, f), 0))
        rows = list(most.items())
        yield pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in rows], pa.int32()), pa.array([r[0][1] for r in rows], pa.string()), pa.array([r[0][2] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["toxic", "entry", "family", "n"])

    found = sample.select("toxic", "folded", "family").mapInArrow(count, "toxic int, entry string, family long, n long").groupBy("toxic", "entry", "family").agg(F.max("n").alias("n"))
    out: dict = {0: {}, 1: {}}
    for r in found.groupBy("toxic", "entry").agg(F.count("*").alias("families"), F.sum("n").alias("n")).collect():  # at most two rows an entry
        out[r["toxic"]][r["entry"]] = (r["families"], r["n"])
    return out


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN,
        exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Learn weights, exceptions and curve from ``docs`` (doc_id, text) joined with ``labels`` (doc_id, toxic).

    An entry's weight is the log of how much more often it occurs per word in
    toxic than in clean documents, less one standard error; copies of a text
    count once.  Without a toxic label the model has no entries.
    """
    python_ready(docs.sparkSession)
    sample, totals = labelled_sample(docs, labels, most_toxic, most_clean)
    alphabet = ordinary_letters(sample)
    sample = folded_sample(sample, alphabet)
    model = Model(alphabet=alphabet, exceptions=sorted({fold_text(x, Folding(alphabet)) for x in exceptions}))
    sizes = {r["toxic"]: (r["docs"], r["words"]) for r in sample.groupBy("toxic", "family").agg(F.max("words").alias("words")).groupBy("toxic").agg(F.count("*").alias("docs"), F.sum("words").alias("words")).collect()}
    if 1 not in sizes:
        return model
    n_docs = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic_docs = {r["entry"]: r["n"] for r in documents_with(sample, 1).where(F.col("n") >= LEAST_SUPPORT).orderBy(F.desc("n"), "entry").limit(20 * MOST_ENTRIES).collect()}
    clean_docs = {r["entry"]: r["n"] for r in documents_with(sample, 0, frozenset(toxic_docs)).collect()}
    odd = {e for e, n in toxic_docs.items() if n / n_docs[1] > 1.5 * clean_docs.get(e, 0) / max(1, n_docs.get(0, 0))}
    by = families_with(sample, frozenset(odd))
    chosen: dict[str, float] = {}
    for e in sorted(by[1], key=lambda x: (len(x.rstrip()) + x.endswith(" "), x)):
        (t, t_n), (c, c_n) = by[1][e], by[0].get(e, (0, 0))
        odds = ((t_n + 0.5) / (sizes[1][1] + 1)) / ((c_n + 0.5) / (sizes.get(0, (0, 0))[1] + 1))
        if t < LEAST_SUPPORT or t < LEAST_VARIETY * toxic_docs[e] or odds < LEAST_ODDS:
            continue
        w = min(8.0, math.log(odds) - math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)))
        stem = e.rstrip()
        known = max((chosen.get(stem[:n], 0.0) for n in STEMS if len(stem) > n or e.endswith(" ") and len(stem) == n), default=0.0)
        if w > known + 0.3:
            chosen[e] = w
    model.weights = dict(sorted(chosen.items(), key=lambda x: (-by[1][x[0]][0], x[0]))[:MOST_ENTRIES])
    model.exceptions = sorted({*model.exceptions, *learned_exceptions(sample, model)})
    points = [(r["toxic"], r["total"], r["n_words"]) for r in with_matches(sample, model, "folded", ("toxic",), folded=True).select("toxic", "total", "n_words").collect()]
    model.curve = curve_of(points, {k: totals.get(k, 0) / n for k, n in n_docs.items()})
    return model


def learned_exceptions(sample: DataFrame, model: Model, least: int = 3) -> list[str]:
    """Two-word phrases around a lexicon word that occur in ``least`` clean families or more and in no toxic one."""
    spec = json.dumps(asdict(model))

    def around(batches: Iterator) -> Iterator:
        import pyarrow as pa

        supported = Supported(frozenset(json.loads(spec)["weights"]))
        out: set = set()
        for b in batches:
            for label, t, f in zip(*(b.column(c).to_pylist() for c in ("toxic", "folded", "family")), strict=True):
                w = t.split()
                hit = {x for x in set(w) if supported[x]}
                for x, y in zip(w, w[1:], strict=False):
                    if x in hit or y in hit:
                        out.add((f"{x} {y}", label, f))
        rows = list(out)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], ["phrase", "toxic", "family"])

    pairs = sample.mapInArrow(around, "phrase string, toxic int, family long").groupBy("phrase").agg(
        F.countDistinct(F.when(F.col("toxic") == 0, F.col("family"))).alias("clean"), F.max("toxic").alias("toxic"))
    return [r["phrase"] for r in pairs.where((F.col("clean") >= least) & (F.col("toxic") == 0)).orderBy(F.desc("clean"), "phrase").limit(MOST_ENTRIES).collect()]


def scored(model: Model, automaton, folded: str) -> tuple[float, int, int, float]:
    """Total weight, matches, words and score of a folded text."""
    total, hits = matches(automaton, folded)
    n = folded.count(" ") + bool(folded)
    z = sum(c * x for c, x in zip(model.curve, features(total, n), strict=True))
    return total, hits, n, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def with_matches(docs: DataFrame, model: Model, text: str, keep: tuple[str, ...], folded: bool = False) -> DataFrame:
    """``keep`` columns, ``total`` weight, ``n_hits``, ``n_words`` and ``score`` of every row."""
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(json.dumps(asdict(model)))
    key = f"toxicity:{zlib.crc32(sent.value.encode())}"

    def build():
        m = Model(**json.loads(sent.value))
        return m, m.automaton(), Folding(m.alphabet)

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m, automaton, folding = worker_state(key, build)
        for b in batches:
            rows = []
            for t in b.column(b.num_columns - 1).to_pylist():
                t = (t or "") if folded else fold_text(t, folding)
                rows.append(scored(m, automaton, t))
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.float64(), pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], schema=pa.schema([*list(b.schema)[:-1], *[pa.field(n, c.type) for n, c in zip(("total", "n_hits", "n_words", "score"), cols, strict=True)]]))

    kept = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["total double, n_hits long, n_words long, score double"])
    return kept.mapInArrow(score, schema)


def without_toxic(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose score is below ``least``; nulls and empty texts score as in ``toxicity``."""
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(json.dumps(asdict(model)))
    key = f"toxicity:{zlib.crc32(sent.value.encode())}"

    def build():
        m = Model(**json.loads(sent.value))
        return m, m.automaton(), Folding(m.alphabet)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, automaton, folding = worker_state(key, build)
        for part in texts:
            out = []
            for t in part:
                out.append(scored(m, automaton, fold_text(t, folding))[3])
            yield pd.Series(out, dtype="float64")

    own = f"{free_prefix(docs)}score"
    return docs.withColumn(own, score(F.coalesce(F.col(text).cast("string"), F.lit("")))).where(F.col(own) < least).select(*all_columns(docs))


def toxicity(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: ``keep`` columns, ``score`` (0 to 1), ``total`` weight, ``n_hits``, ``n_words``.

    A null or empty text, or one without a match, gets the curve's value at
    zero; repeated rows are scored each; an empty table gives no rows; columns
    not kept, whatever their names, play no part.  A model fitted without any
    toxic label scores every text near 0.
    """
    return with_matches(docs, model, text, keep)
