"""E: theme taxonomy and tagging.

Tagging is one projection: the lower-cased text is cut into words once, a hash
set keeps the words that any theme names, and only alternatives that are not
plain words are tested as regular expressions, behind one gate pattern per
product type.  The matching theme names are kept in an array column ``themes``
(taxonomy order).  The long ``review_theme`` form is a narrow ``explode`` of
that column, so theme aggregates never need a join back to the reviews.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import WORD, WORD_CLASS_BODY, portable
from feedback_spark.functions.text import parse_themes

#: Theme names from model output that may become columns.
MOST_COLUMNS = 2000


def taxonomy(spark, product_type: str | None = None) -> DataFrame:
    """(product_type, theme, ord, pattern); empty for an unknown type."""
    rows = [
        (pt, theme, i + 1, pat)
        for pt, lst in FV.THEME_PATTERNS.items()
        for i, (theme, pat) in enumerate(lst)
        if product_type is None or pt == product_type
    ]
    return spark.createDataFrame(rows, "product_type string, theme string, ord int, pattern string")


def competitors(spark, product_type: str | None = None) -> DataFrame:
    """G5 dimension: (product_type, name, ord, pattern)."""
    rows = [
        (pt, name, i + 1, pat)
        for pt, lst in FV.COMPETITOR_PATTERNS.items()
        for i, (name, pat) in enumerate(lst)
        if product_type is None or pt == product_type
    ]
    return spark.createDataFrame(rows, "product_type string, name string, ord int, pattern string")


def _stem(pattern: str) -> str:
    # stem=True: drop the trailing boundary so stems like "deliver" match "delivery"
    return pattern[:-2] if pattern.endswith(r"\b") else pattern


def _search_stem(pattern: str) -> str:
    """The pattern without its trailing boundary; a boundary that looks around is faster than one that consumes a character."""
    words, others, whole = split_alternatives(pattern)
    if whole:
        return portable(_stem(pattern))
    # most places are left after a look at one character, if every alternative begins with a letter
    plain = all(re.match(r"[a-z0-9](?![?*{])", x) for x in words + others)
    ahead = f"(?=[{''.join(sorted({x[0] for x in words + others}))}])" if plain else ""
    return f"{ahead}(?<!{WORD})(?:{'|'.join(portable(x) for x in words + others)})"


def theme_array(text_col: str = "review_text", type_col: str = "product_type",
                patterns: dict | None = None, stem: bool = False, lowered: bool = False) -> F.Column:
    """Array of matching themes for the row's product type (taxonomy order)."""
    patterns = patterns or FV.THEME_PATTERNS
    lc = F.col(text_col) if lowered else F.lower(F.col(text_col))
    # one CASE branch per product type: a row only evaluates its own type's patterns
    out = None
    for pt, lst in patterns.items():
        hits = F.filter(F.array(*[F.when(lc.rlike(_search_stem(p) if stem else portable(p)), F.lit(theme)) for theme, p in lst]),
                        lambda x: x.isNotNull())
        cond = F.col(type_col) == pt
        out = F.when(cond, hits) if out is None else out.when(cond, hits)
    return out.otherwise(F.array().cast("array<string>"))


def split_alternatives(pattern: str) -> tuple[list[str], list[str], list[str]]:
    """Plain words and other alternatives of ``\\b(a|b|...)\\b``, and the pattern itself if it has another form.

    A plain word between two boundaries matches where a maximal run of word
    characters equals it, so it can be looked up instead of searched for.
    """
    whole = re.fullmatch(r"\\b\((.*)\)\\b", pattern, re.DOTALL)
    body, parts, depth, in_class, i = whole.group(1) if whole else "", [""], 0, False, 0
    while i < len(body):
        ch = body[i : i + 2] if body[i] == "\\" else body[i]
        i += len(ch)
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        else:
            depth += (ch == "(") - (ch == ")")
            if depth < 0:  # the outer brackets are two groups
                return [], [], [pattern]
            if ch == "|" and depth == 0:
                parts.append("")
                continue
        parts[-1] += ch
    if not whole or "" in parts:
        return [], [], [pattern]
    words = [x for x in parts if re.fullmatch(r"\w+", x)]
    return words, [x for x in parts if x not in words], []


def _search(text: str, alternatives: list[str], patterns: list[str]) -> F.Column:
    """Whether one of the alternatives stands between boundaries in the text, or one of the patterns matches."""
    # boundaries that look around are several times faster in Java than those that consume a character
    inner = [f"(?<!{WORD})(?:{'|'.join(portable(x) for x in alternatives)})(?!{WORD})"] if alternatives else []
    tests = inner + [f"(?:{portable(x)})" for x in patterns]
    return F.col(text).rlike("|".join(tests)) if tests else F.lit(False)


def tag_themes(r: DataFrame, stem: bool = False, patterns: dict | None = None) -> DataFrame:
    """Add ``themes`` (array) by whole-word pattern match.

    ``stem`` drops the trailing boundary: then every pattern is searched for.
    A null text has no theme; an unknown product type has none either.
    """
    patterns = patterns or FV.THEME_PATTERNS
    # the lower-cased text is a column of its own, so that it is made once for all patterns
    lowered = r.withColumn("_lc", F.lower("review_text"))
    if stem:
        return lowered.withColumn("themes", theme_array("_lc", patterns=patterns, stem=True, lowered=True)).drop("_lc")
    cut = {pt: [(theme, *split_alternatives(p)) for theme, p in lst] for pt, lst in patterns.items()}
    named = sorted({w for lst in cut.values() for _, words, _, _ in lst for w in words})
    # an IN list inside the lambda is a hash-set lookup
    tokens = F.split("_lc", f"[^{WORD_CLASS_BODY}]+")
    hits = F.filter(tokens, lambda t: t.isin(named)) if named else F.array().cast("array<string>")
    gate = found = None
    for pt, lst in cut.items():
        is_type = F.col("product_type") == pt
        passes = _search("_lc", [x for _, _, others, _ in lst for x in others], [x for *_, whole in lst for x in whole])
        gate = F.when(is_type, passes) if gate is None else gate.when(is_type, passes)
        tests = []
        for theme, words, others, whole in lst:
            by_word = F.arrays_overlap("_hits", F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
            by_pattern = F.col("_gate") & _search("_lc", others, whole)
            tests.append(F.when(by_word | by_pattern, F.lit(theme)))
        themes = F.array_compact(F.array(*tests))
        found = F.when(is_type, themes) if found is None else found.when(is_type, themes)
    none = F.array().cast("array<string>")
    return (lowered.withColumn("_hits", hits).withColumn("_gate", gate)
            .withColumn("themes", found.otherwise(none)).drop("_lc", "_hits", "_gate"))


def review_theme(r: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Long form (product, review_id, theme, ...) by a narrow explode."""
    keep = keep or []
    return r.select("product", "review_id", *keep, F.explode("themes").alias("theme"))


def theme_ord(spark) -> DataFrame:
    """(product_type, theme, ord) — small, fixed size: broadcast."""
    return F.broadcast(taxonomy(spark).select("product_type", "theme", "ord"))


def _known(known: list[str] | None) -> list[str]:
    return list(dict.fromkeys(known or [t for lst in FV.THEME_PATTERNS.values() for t, _ in lst]))


def theme_flags(r: DataFrame, known: list[str] | None = None, llm_col: str | None = None) -> DataFrame:
    """E4 for any vocabulary: ``theme_flags`` map<string, boolean>.

    Each row has the ``known`` themes (the taxonomy) and, with ``llm_col``, the
    names that its own model output adds; a theme that a row's map lacks is
    false.  One projection, no job: nothing about the vocabulary is needed
    when the plan is built.  Null themes or output: every known theme false.
    """
    names = F.array(*[F.lit(t) for t in _known(known)]).cast("array<string>")
    own = parse_themes(llm_col) if llm_col else F.col("themes")
    keyed = r.withColumn("_own", F.filter(F.coalesce(own, F.array().cast("array<string>")), lambda t: t != ""))
    keys = F.array_union(names, "_own") if llm_col else names
    keyed = keyed.withColumn("_keys", keys)
    flags = F.map_from_arrays("_keys", F.transform("_keys", lambda t: F.array_contains("_own", t)))
    return keyed.withColumn("theme_flags", flags).drop("_own", "_keys")


def themes_wide(r: DataFrame, known: list[str] | None = None, llm_col: str | None = None, limit: int = MOST_COLUMNS) -> DataFrame:
    """One boolean ``theme_<name>`` column per known theme (+ LLM themes).

    The column set must be known when the plan is built; ``known`` defaults to
    the whole taxonomy.  LLM-invented themes are added from ``llm_col`` via a
    distinct over the theme vocabulary; more than ``limit`` of them raise an
    error (no name is left out) and call for ``theme_flags``.
    """
    known = _known(known)
    src = F.col("themes")
    if llm_col:
        parsed = parse_themes(llm_col)
        r = r.withColumn("_llm_themes", parsed)
        vocab = r.select(F.explode("_llm_themes").alias("t")).distinct()
        extra = [x[0] for x in vocab.limit(limit + 1).collect()]
        if len(extra) > limit:
            raise ValueError(f"more than {limit} theme names cannot be columns; theme_flags takes any number")
        known += [t for t in sorted(x for x in extra if x) if t not in known]
        src = F.col("_llm_themes")
    out = r.select("*", *[F.array_contains(src, t).alias(f"theme_{t}") for t in known])
    return out.drop("_llm_themes") if llm_col else out
