"""Registered queries F1-F5 and G1-G7 (Spark plan + DuckDB oracle SQL)."""

from __future__ import annotations

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import PHRASE_TOKEN, SPACE, sql_str
from feedback_spark.operators import metrics as M
from feedback_spark.operators import phrases as PH
from feedback_spark.operators import signals as G
from feedback_spark.plans.base import scored_layer
from feedback_spark.plans.sql_base import rx, sql_list, with_base


def _q(fn):
    return lambda spark, sf: fn(scored_layer(spark, sf))


def tfidf_sql(docs_sql: str, group: list[str], n: int, lo: int, hi: int, tag: str) -> str:
    """CTE chain ``{tag}_out`` = F1 (+ F2 fallback) over ``docs_sql`` (group..., review_id, review_text)."""
    g = ", ".join(group)
    gd = ", ".join(f"d.{c}" for c in group)
    on = " AND ".join(f"a.{c} = b.{c}" for c in group)
    stops = sql_list(FV.ENGLISH_STOP_WORDS)
    grams = ", ".join(
        f"CASE WHEN len(t) >= {k} THEN list_transform(range(1, len(t) - {k} + 2), lambda i: array_to_string(t[i:i + {k - 1}], ' ')) "
        f"ELSE []::VARCHAR[] END" for k in range(lo, hi + 1)
    )
    fstops = sql_list(FV.FALLBACK_STOP_WORDS)
    split = f"string_split_regex(lower(review_text), {sql_str(SPACE + '+')})"
    return f"""
, {tag}_d AS (SELECT * FROM ({docs_sql}) WHERE review_text IS NOT NULL AND length(review_text) > {FV.TFIDF_MIN_CHARS}),
{tag}_nd AS (SELECT {g}, count(*) AS n_docs FROM {tag}_d GROUP BY {g}),
{tag}_big AS (SELECT {gd}, d.review_id, d.review_text, b.n_docs FROM {tag}_d d JOIN {tag}_nd b ON {on.replace('a.', 'd.')} WHERE b.n_docs >= {FV.TFIDF_MIN_DOCS}),
{tag}_tok AS (SELECT {g}, review_id, n_docs,
  list_filter(regexp_extract_all(lower(review_text), {sql_str(PHRASE_TOKEN)}), lambda x: NOT list_contains({stops}, x)) AS t FROM {tag}_big),
{tag}_gr AS (SELECT {g}, review_id, n_docs, unnest(list_concat({grams}, []::VARCHAR[])) AS term FROM {tag}_tok),
{tag}_tf AS (SELECT {g}, review_id, term, count(*) AS tf, any_value(n_docs) AS n_docs FROM {tag}_gr GROUP BY {g}, review_id, term),
{tag}_st AS (SELECT {g}, term, count(*) AS df, sum(tf) AS ttf, any_value(n_docs) AS n_docs FROM {tag}_tf GROUP BY {g}, term),
{tag}_voc AS (SELECT * FROM {tag}_st WHERE df >= {FV.TFIDF_MIN_DF}),
{tag}_w AS (SELECT {', '.join(f'a.{c}' for c in group)}, a.review_id, a.term,
  a.tf * (ln((b.n_docs + 1) / (b.df + 1)) + 1) AS w FROM {tag}_tf a JOIN {tag}_voc b ON {on} AND a.term = b.term),
{tag}_wn AS (SELECT {g}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {g}, review_id)) AS wn FROM {tag}_w),
{tag}_s AS (SELECT {g}, term, sum(wn) AS s FROM {tag}_wn GROUP BY {g}, term),
{tag}_top AS (SELECT {g}, CAST(row_number() OVER (PARTITION BY {g} ORDER BY round(s, 9) DESC, term) AS BIGINT) AS rank,
  term AS phrase, CAST(floor(round(s, 9)) AS BIGINT) AS score, round(s, 6) AS weight, 'tfidf' AS method
  FROM {tag}_s QUALIFY rank <= {n}),
{tag}_small AS (SELECT {gd}, d.review_id, d.review_text FROM {tag}_d d JOIN {tag}_nd b ON {on.replace('a.', 'd.')} WHERE b.n_docs < {FV.TFIDF_MIN_DOCS}),
{tag}_wd AS (SELECT {g}, review_id, unnest({split}) AS word, generate_subscripts({split}, 1) AS pos FROM {tag}_small),
{tag}_wa AS (SELECT {g}, word, count(*) AS cnt, min(review_id * 1048576 + pos) AS first FROM {tag}_wd
  WHERE length(word) > 3 AND NOT list_contains({fstops}, word) GROUP BY {g}, word),
{tag}_wtop AS (SELECT {g}, CAST(row_number() OVER (PARTITION BY {g} ORDER BY cnt DESC, first) AS BIGINT) AS rank,
  word AS phrase, cnt AS score, CAST(cnt AS DOUBLE) AS weight, 'count' AS method FROM {tag}_wa QUALIFY rank <= {n}),
{tag}_out AS (SELECT * FROM {tag}_top UNION ALL SELECT * FROM {tag}_wtop)"""


def _phr(docs_sql, group, n, lo, hi, tag="f"):
    return with_base(tfidf_sql(docs_sql, group, n, lo, hi, tag) + f"\nSELECT * FROM {tag}_out")


SENT = "SELECT product, sentiment, review_id, review_text FROM scored WHERE sentiment IN ('Positive', 'Negative')"
THEME = "SELECT product, unnest(themes) AS theme, review_id, review_text FROM scored"
THEME_NEG = "SELECT product, unnest(themes) AS theme, review_id, review_text FROM scored WHERE sentiment = 'Negative'"


def words_sql(docs_sql: str, group: list[str], n: int) -> str:
    """F2 alone over ``docs_sql`` (group..., review_id, review_text)."""
    g = ", ".join(group)
    fstops = sql_list(FV.FALLBACK_STOP_WORDS)
    split = f"string_split_regex(lower(review_text), {sql_str(SPACE + '+')})"
    return with_base(f"""
, wd AS (SELECT {g}, review_id, unnest({split}) AS word, generate_subscripts({split}, 1) AS pos
         FROM ({docs_sql}) WHERE length(review_text) > {FV.TFIDF_MIN_CHARS}),
wa AS (SELECT {g}, word, count(*) AS cnt, min(review_id * 1048576 + pos) AS first FROM wd
  WHERE length(word) > 3 AND NOT list_contains({fstops}, word) GROUP BY {g}, word)
SELECT {g}, CAST(row_number() OVER (PARTITION BY {g} ORDER BY cnt DESC, first) AS BIGINT) AS rank,
  word AS phrase, cnt AS score, CAST(cnt AS DOUBLE) AS weight FROM wa QUALIFY rank <= {n}""")


def _sentences_sql(src: str) -> str:
    parts = f"regexp_split_to_array(review_text, {sql_str(FV.SENTENCE_SPLIT)})"
    return (f"SELECT product, review_id, unnest({parts}) AS raw, generate_subscripts({parts}, 1) - 1 AS pos FROM ({src})")


def _snippet_top(x_sql: str, n: int) -> str:
    return f"""SELECT product, CAST(rank AS BIGINT) AS rank, snippet, n, first_review_id FROM (
  SELECT product, snippet, count(*) AS n, min(review_id * 1048576 + pos) AS _first,
         CAST(min(review_id * 1048576 + pos) // 1048576 AS BIGINT) AS first_review_id,
         row_number() OVER (PARTITION BY product ORDER BY count(*) DESC, min(review_id * 1048576 + pos)) AS rank
  FROM ({x_sql}) GROUP BY product, snippet) WHERE rank <= {n}"""


def _g1_sql() -> str:
    from feedback_spark.plans.sql_base import trim_sql
    s = _sentences_sql("SELECT * FROM scored WHERE sentiment IN ('Negative', 'Neutral')")
    x = f"""SELECT product, review_id, pos, substr(s, 1, {FV.SNIPPET_CHARS}) AS snippet FROM (
  SELECT *, {trim_sql('raw')} AS s FROM ({s}))
  WHERE {rx('lower(s)', FV.FEATURE_REQUEST_PATTERN)} AND NOT {rx('lower(s)', FV.REQUEST_SUPPRESS_PATTERN)}
    AND length(s) > {FV.REQUEST_MIN_LEN} AND length(s) < {FV.REQUEST_MAX_LEN}"""
    return with_base(_snippet_top(x, 6))


def _g3_sql() -> str:
    from feedback_spark.plans.sql_base import trim_sql
    s = _sentences_sql(f"SELECT * FROM scored WHERE {rx('lower(review_text)', FV.CHURN_PATTERN)}")
    x = f"""SELECT product, review_id, pos, substr(s, 1, {FV.SNIPPET_CHARS}) AS snippet FROM (
  SELECT *, {trim_sql('raw')} AS s FROM ({s}))
  WHERE {rx('lower(raw)', FV.CHURN_PATTERN)} AND length(s) > {FV.CHURN_MIN_LEN}"""
    return with_base(_snippet_top(x, 4))


def _comp_hits() -> str:
    return ", ".join(
        f"CASE WHEN product_type = {sql_str(pt)} AND {rx('lower(review_text)', p)} THEN {{'name': {sql_str(name)}, 'ord': {i + 1}}} END"
        for pt, lst in FV.COMPETITOR_PATTERNS.items() for i, (name, p) in enumerate(lst)
    )


MENTIONS_CTE = f"""
, cm AS (SELECT product, c.name AS competitor, c.ord AS ord, count(*) AS mentions FROM (
    SELECT product, unnest(list_filter([{_comp_hits()}], lambda x: x IS NOT NULL)) AS c FROM scored)
  WHERE lower(c.name) <> lower(product) GROUP BY ALL)"""


def _g6_sql() -> str:
    lit_hits = ", ".join(
        f"CASE WHEN product_type = {sql_str(pt)} AND contains(lower(review_text), {sql_str(name.lower())}) THEN {sql_str(name)} END"
        for pt, lst in FV.COMPETITOR_PATTERNS.items() for name, _ in lst
    )
    return with_base(MENTIONS_CTE + f""",
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY product ORDER BY mentions DESC, ord) AS BIGINT) AS rank FROM cm QUALIFY rank <= 7),
ctx AS (SELECT product, competitor, CAST(sum(CASE WHEN sentiment = 'Positive' THEN 1 ELSE 0 END) AS BIGINT) AS pos,
               CAST(sum(CASE WHEN sentiment = 'Negative' THEN 1 ELSE 0 END) AS BIGINT) AS neg
        FROM (SELECT product, sentiment, unnest(list_filter([{lit_hits}], lambda x: x IS NOT NULL)) AS competitor FROM scored)
        GROUP BY ALL)
SELECT t.product, t.rank, t.competitor, t.mentions, coalesce(c.pos, 0) AS pos, coalesce(c.neg, 0) AS neg,
       CASE WHEN coalesce(c.pos, 0) > coalesce(c.neg, 0) THEN 'praised' WHEN coalesce(c.neg, 0) > coalesce(c.pos, 0) THEN 'criticised'
            ELSE 'neutral' END AS badge,
       CAST(floor(t.mentions / max(t.mentions) OVER (PARTITION BY t.product) * 100) AS BIGINT) AS share
FROM top t LEFT JOIN ctx c ON c.product = t.product AND c.competitor = t.competitor""")


def _g7_sql() -> str:
    from feedback_spark.plans.q_metrics import HEALTH_CTES
    from feedback_spark.plans.sql_base import trim_sql
    s = _sentences_sql("SELECT * FROM scored WHERE sentiment IN ('Negative', 'Neutral')")
    x = f"""SELECT product, review_id, pos, substr(s, 1, {FV.SNIPPET_CHARS}) AS snippet FROM (
  SELECT *, {trim_sql('raw')} AS s FROM ({s}))
  WHERE {rx('lower(s)', FV.FEATURE_REQUEST_PATTERN)} AND NOT {rx('lower(s)', FV.REQUEST_SUPPRESS_PATTERN)}
    AND length(s) > {FV.REQUEST_MIN_LEN} AND length(s) < {FV.REQUEST_MAX_LEN}"""
    return with_base(tfidf_sql(THEME_NEG, ["product", "theme"], 1, 1, 3, "neg") + HEALTH_CTES + MENTIONS_CTE + f""",
wk AS (SELECT product, theme, negative, row_number() OVER (PARTITION BY product ORDER BY score, total DESC, ord) AS rank
       FROM hs WHERE score < -0.05 QUALIFY rank <= 3),
rq AS ({_snippet_top(x, 6)}),
items AS (
  SELECT w.product, 1 AS kind_rank, w.rank, 'weakness' AS kind, w.theme AS item, w.negative AS cnt, substr(n.phrase, 1, 60) AS hint
  FROM wk w LEFT JOIN (SELECT * FROM neg_out WHERE rank = 1) n ON n.product = w.product AND n.theme = w.theme
  UNION ALL SELECT product, 2, rank, 'request', substr(snippet, 1, 80), n, NULL FROM rq WHERE rank <= 2
  UNION ALL SELECT product, 3, 1, 'competitor', competitor, mentions, NULL FROM cm
  QUALIFY row_number() OVER (PARTITION BY product ORDER BY mentions DESC, ord) = 1)
SELECT product, CAST(row_number() OVER (PARTITION BY product ORDER BY kind_rank, rank) AS BIGINT) AS gap, kind, item,
       CAST(cnt AS BIGINT) AS count, hint FROM items QUALIFY gap <= 5""")


def _g7(r):
    health = M.theme_health(r)
    weak = M.strengths_weaknesses(health)
    neg = PH.phrases_by_theme(r, 1, sentiment="Negative")
    return G.opportunity_gaps(weak, neg, G.feature_requests(r), G.competitor_mentions(r))


QUERIES = {
    "f1_top_phrases": (_q(lambda r: PH.top_phrases(r, ["product"], 20, (2, 3))),
                       _phr("SELECT product, review_id, review_text FROM scored", ["product"], 20, 2, 3)),
    "f2_top_words": (_q(lambda r: PH.top_words(r.filter("length(review_text) > 10"), ["product", "platform"], 20)),
                     words_sql("SELECT product, platform, review_id, review_text FROM scored", ["product", "platform"], 20)),
    "f3_phrases_by_sentiment": (_q(PH.phrases_by_sentiment), _phr(SENT, ["product", "sentiment"], 6, 1, 3)),
    "f4_phrases_by_theme": (_q(PH.phrases_by_theme), _phr(THEME, ["product", "theme"], 15, 1, 3)),
    "f4_negative_theme_hint": (_q(lambda r: PH.phrases_by_theme(r, 1, sentiment="Negative")),
                               _phr(THEME_NEG, ["product", "theme"], 1, 1, 3)),
    "f5_phrases_by_platform": (_q(PH.phrases_by_platform),
                               _phr("SELECT product, platform, review_id, review_text FROM scored", ["product", "platform"], 25, 2, 3)),
    "g1_feature_requests": (_q(G.feature_requests), _g1_sql()),
    "g3_churn_sentences": (_q(G.churn_sentences), _g3_sql()),
    "g5_competitor_mentions": (_q(G.competitor_mentions), with_base(MENTIONS_CTE + "\nSELECT * FROM cm")),
    "g6_competitor_context": (_q(lambda r: G.competitor_context(r, G.competitor_mentions(r))), _g6_sql()),
    "g7_opportunity_gaps": (_q(_g7), _g7_sql()),
}

