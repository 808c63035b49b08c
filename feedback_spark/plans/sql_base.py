"""DuckDB SQL for the shared plan prefixes (the oracle side of plans.base).

``with_base(select_sql)`` returns ``WITH <base CTEs> <select_sql>``; the
CTEs are ``reviews``, ``cleaned``, ``clean`` (deduplicated), ``scored`` and
``review_theme``.  All regexes are the same ``portable`` strings the Spark
plans use.
"""

from __future__ import annotations

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import LEXICON_TOKEN, TRIM_PATTERN, portable, sql_str


def sql_list(values) -> str:
    return "[" + ", ".join(sql_str(v) if isinstance(v, str) else repr(v) for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join(sql_str(v) for v in values) + ")"


def trim_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {sql_str(TRIM_PATTERN)}, '', 'g')"


def rx(expr: str, pattern: str) -> str:
    """Contains-test of a Python-syntax pattern (portable form)."""
    return f"regexp_matches({expr}, {sql_str(portable(pattern))})"


def reviews_cte() -> str:
    prods = sql_list([p[0] for p in FV.PRODUCTS])
    types = sql_list([p[1] for p in FV.PRODUCTS])
    plats = sql_list(FV.ADAPTER_PLATFORMS)
    phrases = sql_list(FV.ADAPTER_PHRASES)
    np_, nplat, nph = len(FV.PRODUCTS), len(FV.ADAPTER_PLATFORMS), len(FV.ADAPTER_PHRASES)
    return f"""reviews AS (
  SELECT doc_id AS review_id,
         {prods}[CAST(n_chars % {np_} AS INTEGER) + 1] AS product,
         {types}[CAST(n_chars % {np_} AS INTEGER) + 1] AS product_type,
         {plats}[CAST(doc_id % {nplat} AS INTEGER) + 1] AS platform,
         CAST(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER) AS DATE) AS date,
         'user_' || CAST(doc_id % 50 AS VARCHAR) AS author,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(1 + doc_id % 5 AS DOUBLE) END AS rating,
         text || ' ' || {phrases}[CAST((n_chars // 4) % {nph} AS INTEGER) + 1] AS review_text,
         'https://reviews.example/' || {plats}[CAST(doc_id % {nplat} AS INTEGER) + 1] || '/' || CAST(doc_id AS VARCHAR) AS source_url
  FROM documents)"""


def lexicon_values(idioms: list[tuple[str, float]] = ()) -> str:
    rows = ", ".join(f"({sql_str(t)}, CAST({v!r} AS DOUBLE))" for t, v in [*FV.DEFAULT_LEXICON, *idioms])
    return f"lex(token, valence) AS (VALUES {rows})"


def _booster(expr: str) -> str:
    return (f"(CASE WHEN {expr} IN {sql_in(FV.BOOSTER_UP)} THEN {FV.BOOSTER_STEP} "
            f"WHEN {expr} IN {sql_in(FV.BOOSTER_DOWN)} THEN -{FV.BOOSTER_STEP} ELSE 0.0 END)")


def _idiom_tokens(idioms: list[tuple[str, float]]) -> str:
    """The token list ``rt0`` with idioms as one token: alternatives, longest first, over tokens that two blanks part."""
    longest = sorted((p for p, _ in idioms), key=lambda p: -len(p.split()))
    pattern = "(?i) (" + "|".join(p.replace(" ", "  ") for p in longest) + "|[^ ]+) "
    return f"list_transform(regexp_extract_all('  ' || array_to_string(rt0, '  ') || '  ', {sql_str(pattern)}, 1), lambda x: replace(x, '  ', ' '))"


def scoring_ctes(src: str = "clean1", out: str = "scored", idioms: list[tuple[str, float]] = ()) -> str:
    """D1-D5 + E2 over CTE ``src`` (columns of the review schema); ``idioms``: phrases of several words, each one token."""
    boost = " + ".join(
        f"(CASE WHEN p > {d} THEN ({_booster(f't[p - {d}]')} + CASE WHEN mixed AND u[p - {d}] AND {_booster(f't[p - {d}]')} <> 0 "
        f"THEN {FV.CAPS_STEP} ELSE 0.0 END) * {FV.BOOSTER_DISTANCE_SCALE[d - 1]} ELSE 0.0 END)"
        for d in (1, 2, 3)
    )
    neg = " OR ".join(f"(p > {d} AND t[p - {d}] IN {sql_in(FV.NEGATION_WORDS)})" for d in (1, 2, 3))
    hits = ", ".join(
        f"CASE WHEN product_type = {sql_str(pt)} AND {rx('lower(review_text)', p)} THEN {sql_str(theme)} END"
        for pt, lst in FV.THEME_PATTERNS.items()
        for theme, p in lst
    )
    thr = FV.LABEL_THRESHOLD
    return f"""{lexicon_values(idioms)},
toks AS (SELECT product, review_id, list_transform(rt, lambda x: lower(x)) AS t, u, len(list_filter(u0, lambda x: x)) BETWEEN 1 AND len(u0) - 1 AS mixed
         FROM (SELECT *, list_transform(rt, lambda x: x = upper(x) AND x <> lower(x)) AS u, list_transform(rt0, lambda x: x = upper(x) AND x <> lower(x)) AS u0
               FROM (SELECT *, {_idiom_tokens(idioms) if idioms else 'rt0'} AS rt
                     FROM (SELECT product, review_id, regexp_extract_all(review_text, {sql_str(LEXICON_TOKEN)}) AS rt0 FROM {src})))),
tk AS (SELECT product, review_id, t, u, mixed, unnest(t) AS tok, generate_subscripts(t, 1) AS p FROM toks),
tv AS (
  SELECT tk.product, tk.review_id, tk.p, lex.valence AS v0, ({boost}) + (CASE WHEN mixed AND u[p] THEN {FV.CAPS_STEP} ELSE 0.0 END) AS boost, ({neg}) AS negated,
         (p > 1 AND t[p - 1] = 'least' AND NOT (p > 2 AND t[p - 2] IN {sql_in(FV.LEAST_SPARED)})) AS leastly,
         coalesce(list_position(tk.t, 'but'), 0) AS fb
  FROM tk JOIN lex ON lex.token = tk.tok),
tv2 AS (
  SELECT product, review_id,
         (CASE WHEN v0 > 0 THEN v0 + boost ELSE v0 - boost END)
         * (CASE WHEN leastly THEN {FV.NEGATION_SCALE} ELSE 1.0 END) * (CASE WHEN negated THEN {FV.NEGATION_SCALE} ELSE 1.0 END)
         * (CASE WHEN fb > 0 AND p < fb THEN {FV.BUT_BEFORE} WHEN fb > 0 AND p > fb THEN {FV.BUT_AFTER} ELSE 1.0 END) AS v
  FROM tv),
tsum AS (SELECT product, review_id, sum(v) AS s FROM tv2 GROUP BY product, review_id),
pol AS (
  SELECT c.*, coalesce(tsum.s, 0.0) AS s0,
         least(length(c.review_text) - length(replace(c.review_text, '!', '')), {FV.EXCLAIM_MAX}) * {FV.EXCLAIM_STEP}
         + CASE WHEN length(c.review_text) - length(replace(c.review_text, '?', '')) > {FV.QUESTION_MANY} THEN {FV.QUESTION_MOST}
                WHEN length(c.review_text) - length(replace(c.review_text, '?', '')) > 1
                THEN (length(c.review_text) - length(replace(c.review_text, '?', ''))) * {FV.QUESTION_STEP} ELSE 0.0 END AS amp
  FROM {src} c LEFT JOIN tsum ON tsum.product = c.product AND tsum.review_id = c.review_id),
pol2 AS (
  SELECT *, CASE WHEN s0 > 0 THEN s0 + amp WHEN s0 < 0 THEN s0 - amp ELSE s0 END AS s2 FROM pol),
pol3 AS (
  SELECT * EXCLUDE (s0, amp, s2),
         round(greatest(-1.0, least(1.0, s2 / sqrt(s2 * s2 + {FV.COMPOUND_ALPHA}))), 4) AS sentiment_raw
  FROM pol2),
lane AS (
  SELECT *,
         CASE WHEN rating >= 4 THEN 'Positive' WHEN rating = 3 THEN 'Neutral' WHEN rating <= 2 THEN 'Negative' END AS r_lab,
         CASE WHEN rating >= 4 OR rating <= 2 THEN round((rating - 3) / 2, 2) WHEN rating = 3 THEN 0.0 END AS r_sc,
         (sentiment_raw < -{thr} AND {rx('lower(review_text)', FV.SUCCESS_STORY_PATTERN)}
          AND NOT {rx('lower(review_text)', FV.PRODUCT_COMPLAINT_PATTERN)}) AS corr
  FROM pol3),
{out} AS (
  SELECT * EXCLUDE (r_lab, r_sc, corr, sentiment_score, sentiment) ,
         sentiment, sentiment_score, abs(sentiment_score - sentiment_raw) > 1e-9 AS sentiment_corrected,
         list_filter([{hits}], lambda x: x IS NOT NULL) AS themes
  FROM (SELECT *,
               coalesce(r_lab, CASE WHEN corr THEN 'Positive' WHEN sentiment_raw >= {thr} THEN 'Positive'
                                    WHEN sentiment_raw <= -{thr} THEN 'Negative' ELSE 'Neutral' END) AS sentiment,
               coalesce(r_sc, CASE WHEN corr THEN {FV.SUCCESS_STORY_SCORE} ELSE sentiment_raw END) AS sentiment_score
        FROM lane))"""


def base_ctes() -> str:
    t = trim_sql("review_text")
    return f"""{reviews_cte()},
cleaned AS (
  SELECT review_id, product, product_type, platform, TRY_CAST(CAST(date AS VARCHAR) AS DATE) AS date, author,
         TRY_CAST(CAST(rating AS VARCHAR) AS DOUBLE) AS rating, {t} AS review_text, source_url
  FROM reviews WHERE length({t}) > {FV.MIN_TEXT_LEN_INGEST}),
clean AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY product, review_text ORDER BY review_id) = 1),
clean1 AS (SELECT * REPLACE ({t} AS review_text) FROM clean WHERE length({t}) > {FV.MIN_TEXT_LEN}),
{scoring_ctes('clean1', 'scored')},
review_theme AS (SELECT product, review_id, unnest(themes) AS theme FROM scored),
taxo(product_type, theme, ord) AS (VALUES {taxonomy_values()})"""


def taxonomy_values() -> str:
    return ", ".join(
        f"({sql_str(pt)}, {sql_str(theme)}, {i + 1})"
        for pt, lst in FV.THEME_PATTERNS.items()
        for i, (theme, _) in enumerate(lst)
    )


def with_base(select_sql: str) -> str:
    return f"WITH {base_ctes()}\n{select_sql}"
