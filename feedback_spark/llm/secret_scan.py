"""Secret scan in DataFrame expressions only: three fixed patterns and a randomness test battery.

The battery looks at whole runs of token characters (20 or more).  For each it
infers an encoding (hex, base32, base36, base62, base64) and asks how likely an
ordinary word, identifier or path would look as random as the run does:

* alphabet uniformity: the chi-squared statistic of the symbol counts, set
  against the level that ordinary text reaches at this length;
* runs: changes of character class (lower, upper, digit, other) between
  neighbours, set against identifiers' rate;
* serial correlation of the symbols' places in the alphabet at lag 1.

Fisher's sum joins the three p-values.  Benjamini-Hochberg then controls the
share of false discoveries over the whole table, separately for each length
band, so that many short runs do not pay for, or hide behind, long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from feedback_spark.llm.common import all_columns, free_prefix

# The base patterns, and the least length of group 2, of the match, of the match.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "random")
#: A whole run of token characters: what the battery tests.  A run may follow ``=``; ``=`` is padding only where no token character comes next.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}+(?![A-Za-z0-9+/_-]))?+"
#: name -> (whole-run pattern, alphabet in order, chance that two symbols of ordinary text agree)
ENCODINGS = {
    "hex": (r"[0-9a-f]+|[0-9A-F]+", "0123456789abcdef", 0.125),
    "base32": (r"[A-Z2-7]+=*", "abcdefghijklmnopqrstuvwxyz234567", 0.075),
    "base36": (r"[a-z0-9]+", "0123456789abcdefghijklmnopqrstuvwxyz", 0.075),
    "base62": (r"[A-Za-z0-9]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 0.06),
    "base64": (r".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", 0.06),
}
CASELESS = ("hex", "base32")
#: Ordinary text: chance that three symbols agree less the square of the above; rate of class changes; spread of the lag-1 correlation.
TRIPLE, CHANGES, SPREAD = 0.0015, 0.3, 0.35
#: Share of false discoveries allowed, and bins to a factor of ten of the p-value.
ALPHA, BINS, LAST_BIN = 0.01, 20, 400


def normal(z: Column) -> Column:
    """Distribution function of the normal law (logistic approximation, error below 2e-4)."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(-z * (1.5976 + z * z * 0.07056)))


def placed(text: Column, found: Column, pattern: str, value: Column) -> Column:
    """Spans (start, end, value) of the matches ``found`` of ``pattern``, in code points, from the pieces between them."""
    pieces = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.length)
    steps = F.zip_with(F.zip_with(pieces, F.transform(found, F.length), lambda g, n: F.struct(g.alias("gap"), n.alias("n"))), value,
                       lambda x, v: F.struct(x["gap"].alias("gap"), x["n"].alias("n"), v.alias("value")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda a, x: F.struct(
        (a["at"] + x["gap"] + x["n"]).alias("at"),
        F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("end"), x["value"].alias("value")))).alias("out")))
    return F.when(F.size(found) > 0, walked["out"]).otherwise(empty)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def neighbours(values: Column, f) -> Column:
    """``f`` of each element and the next."""
    n = F.size(values)
    return F.zip_with(F.slice(values, 1, n - 1), F.slice(values, 2, n - 1), f)


def by_encoding(run: Column, value) -> Column:
    """``value(name)`` of the first encoding whose pattern the whole run matches."""
    out = F.lit(None)
    for name, (pattern, _, _) in reversed(list(ENCODINGS.items())):
        out = F.when(run.rlike(f"^(?:{pattern})$"), F.lit(value(name))).otherwise(out)
    return out


def p_values(runs: Column) -> Column:
    """Fisher's joint p-value of each run of an array: how likely ordinary text looks as random as it does."""

    def step(rows: Column, old: list[str], new) -> tuple[Column, list[str]]:
        added: list[str] = []

        def grown(s: Column) -> Column:
            more = new(s)
            added[:] = list(more)
            return F.struct(*[s[c].alias(c) for c in old], *[v.alias(c) for c, v in more.items()])

        out = F.transform(rows, grown)
        return out, old + added

    body = lambda s: F.rtrim(s["run"], F.lit("="))
    rows, names = step(F.transform(runs, lambda r: F.struct(r.alias("run"))), ["run"], lambda s: {
        "raw": F.split(body(s), ""),
        "symbols": F.split(F.when(by_encoding(s["run"], lambda e: e in CASELESS), F.lower(body(s))).otherwise(body(s)), ""),
        "alphabet": by_encoding(s["run"], lambda e: ENCODINGS[e][1]),
        "k": by_encoding(s["run"], lambda e: 64.0 if e == "base64" else float(len(ENCODINGS[e][1]))),
        "same": by_encoding(s["run"], lambda e: ENCODINGS[e][2]),
        "n": F.greatest(F.lit(2.0), F.length(body(s)).cast("double")),
    })
    kinds = lambda s: F.transform(s["raw"], lambda c: F.when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).when(c.between("0", "9"), 3).otherwise(4))
    rows, names = step(rows, names, lambda s: {
        "counts": F.transform(F.array_distinct(s["symbols"]), lambda c: F.size(F.filter(s["symbols"], lambda x: x == c)).cast("double")),
        "kinds": kinds(s),
        "place": F.transform(s["symbols"], lambda c: F.instr(s["alphabet"], c).cast("double")),
    })
    rows, names = step(rows, names, lambda s: {"mean": total(s["place"]) / s["n"]})
    rows, names = step(rows, names, lambda s: {"off": F.transform(s["place"], lambda x: x - s["mean"])})
    rows, names = step(rows, names, lambda s: {
        "chi": total(F.transform(s["counts"], lambda c: c * c)) * s["k"] / s["n"] - s["n"],  # chi-squared against the uniform alphabet
        "changes": total(neighbours(s["kinds"], lambda a, b: (a != b).cast("double"))),
        "power": total(F.transform(s["off"], lambda x: x * x)),
        "lagged": total(neighbours(s["off"], lambda a, b: a * b)),
    })

    def tests(s: Column) -> dict[str, Column]:
        n, k, same = s["n"], s["k"], s["same"]
        agree = (s["chi"] + n - k) / (k * (n - 1))  # chi-squared as a share of agreeing pairs
        r = F.when(s["power"] > 0, s["lagged"] / s["power"]).otherwise(F.lit(1.0))
        return {"uniform": normal((agree - same) / F.sqrt(2 * same * (1 - same) / (n * (n - 1)) + 4 * TRIPLE / n)),
                "runs": normal((CHANGES * (n - 1) - s["changes"]) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES))),
                "serial": 2 * normal(F.abs(r) / SPREAD) - 1}

    rows, names = step(rows, names, tests)
    rows, names = step(rows, names, lambda s: {"x": -sum((F.log(F.greatest(F.lit(1e-12), s[t])) for t in ("uniform", "runs", "serial")), F.lit(0.0))})
    return F.transform(rows, lambda s: F.least(F.lit(1.0), F.exp(-s["x"]) * (1 + s["x"] + s["x"] * s["x"] / 2)))


def band(n: Column) -> Column:
    """Length band of a run."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def tail_bin(p: Column) -> Column:
    return F.least(F.lit(LAST_BIN), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * BINS)).cast("int")


def run_of(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(RUN), F.lit(0))


def judged(runs: Column) -> Column:
    """Length band and p-value bin of each run of an array."""
    return F.zip_with(runs, p_values(runs), lambda r, p: F.struct(band(F.length(r)).alias("band"), tail_bin(p).alias("bin")))


def thresholds(docs: DataFrame, text: str = "text", alpha: float = ALPHA) -> dict[int, int]:
    """Least p-value bin that counts as a discovery, by length band (Benjamini-Hochberg on bins; a few rows)."""
    runs = docs.select(run_of(text).alias("runs")).where(F.size("runs") > 0)
    bins = runs.select(F.inline(judged(F.col("runs")))).groupBy("band", "bin").agg(F.count("*").alias("n"))
    # a row per band and bin: at most 31 x (LAST_BIN + 1) rows from here on
    ranked = bins.select("band", "bin", F.sum("n").over(W.partitionBy("band").orderBy(F.desc("bin"))).alias("rank"), F.sum("n").over(W.partitionBy("band")).alias("all"))
    good = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS))) <= F.col("rank") * alpha / F.col("all"))
    return {r["band"]: r["bin"] for r in good.groupBy("band").agg(F.min("bin").alias("bin")).collect()}


def with_spans(docs: DataFrame, limits: dict[int, int], text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: array of (start, rank of the kind, end) by start and kind, in code points, ends exclusive (an own column of that name is replaced)."""
    pre = free_prefix(docs)
    assign, access, hex_, random_, base, added = (pre + k for k in ("assign", "access", "hex", "random", "base", "added"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.withColumns({k: F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for k, p in ((assign, ASSIGN), (access, ACCESS), (hex_, HEX))} | {random_: run_of(text)})
    values = F.when(F.size(assign) > 0, F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>"))
    table = F.create_map(*[F.lit(x) for kv in sorted((limits or {-1: 0}).items()) for x in kv])
    at = found.withColumns({
        assign: F.filter(placed(whole, F.col(assign), ASSIGN, values), lambda s: F.length(s["value"]) >= ASSIGN_LEAST),
        access: placed(whole, F.col(access), ACCESS, F.col(access)),
        hex_: placed(whole, F.col(hex_), HEX, F.col(hex_)),
        # place and verdict side by side: the battery is evaluated once for the text, not once for each run
        random_: F.when(F.size(random_) > 0, F.zip_with(placed(whole, F.col(random_), RUN, F.col(random_)), judged(F.col(random_)), lambda s, x: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.coalesce(x["bin"] >= F.element_at(table, x["band"]), F.lit(False)).alias("good")))).otherwise(
            F.array().cast("array<struct<start:int,end:int,good:boolean>>")),
    })
    as_spans = lambda c, k: F.transform(c, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end")))
    chosen = F.filter(random_, lambda s: s["good"])
    placed_all = at.withColumns({base: F.sort_array(F.concat(*[as_spans(F.col(k), i) for i, k in enumerate((assign, access, hex_))])), added: as_spans(chosen, 3)})
    # how far the base spans, in order, cover the run from its start without a hole
    reached = lambda s: F.aggregate(base, s["start"], lambda a, b: F.when((b["start"] <= a) & (a < b["end"]), b["end"]).otherwise(a))
    open_ = F.filter(added, lambda s: reached(s) < s["end"])
    return placed_all.withColumn(out, F.sort_array(F.concat(base, open_))).select(*[c for c in all_columns(docs) if c != f"`{out}`"], out)


def listed(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end, comma-joined."""
    s = F.filter(spans, lambda x: x["rank"] < 3) if base_only else spans
    name = lambda x: F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["rank"] + 1)
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), alpha: float = ALPHA, out: str = "spans") -> DataFrame:
    """One row per input row: ``keep`` columns and ``out``, the array of (start, rank of the kind, end).

    Base kinds: assign (group 2 of 8 or more characters), access, hex, each
    leftmost and non-overlapping; random runs (20 characters or more) that the
    battery finds are added unless base spans cover them whole.  A null or empty text has no spans;
    repeated rows are scanned each; an empty table gives no rows.
    """
    limits = thresholds(docs, text, alpha)
    own = f"{free_prefix(docs)}spans"
    return with_spans(docs, limits, text, own).select(*keep, F.col(own).alias(out))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch covered by spans replaced by ``mark`` (null stays null)."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("out"))))
    return F.when(F.size(spans) > 0, F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text) - walked["at"]))).otherwise(text)


def redact(docs: DataFrame, text: str = "text", alpha: float = ALPHA) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced by a mark; all rows and columns stay."""
    own = f"{free_prefix(docs)}spans"
    found = with_spans(docs, thresholds(docs, text, alpha), text, own)
    return found.withColumn(text, redacted(F.col(text), F.col(own))).select(*all_columns(docs))


def digest(spans: Column) -> dict[str, Column]:
    """The contract's columns from the spans."""
    count = lambda k: F.size(F.filter(spans, lambda s: s["rank"] == k)).cast("long")
    return {**{f"n_{k}": count(i) for i, k in enumerate(KINDS)}, "base_sha256": F.sha2(listed(spans, True).cast("binary"), 256), "spans": listed(spans)}
