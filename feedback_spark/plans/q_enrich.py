"""Registered queries K1-K21, H15, H16, G2, G4 (Spark plan + DuckDB oracle SQL).

The model's output is not available, so a stand-in response table is derived
from ``documents`` (through the reviews adapter) and ``labels``: one JSON
file per batch of 5 reviews, damaged in a fixed rotation (fenced, wrapped,
cut inside an object, missing bracket, trailing prose, no array), with text
and absent ``idx`` values, out-of-range ``idx`` values and a retry folder
whose files override earlier answers.  Both engines build byte-identical
bodies from the same pieces (:class:`Txt`).
"""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import SPACE, sql_str
from feedback_spark.operators import clean as C
from feedback_spark.operators import enrich as K
from feedback_spark.operators import metrics as M
from feedback_spark.functions.text import between_fences
from feedback_spark.operators import signals as G
from feedback_spark.plans.base import clean_layer
from feedback_spark.plans.sql_base import trim_sql
from feedback_spark.session import input_state
from feedback_spark.sources import layers as L
from feedback_spark.sources.testdata import products, table
from feedback_spark.streaming.stream import work_dir

BATCH = FV.ONLINE_BATCH  # batch size of the stand-in responses


class Txt:
    """A string built from pieces, rendered both as a Spark Column and as SQL."""

    def __init__(self, *pieces):
        self.pieces = pieces

    def spark(self) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p[0]() for p in self.pieces])

    def sql(self) -> str:
        return "(" + " || ".join(sql_str(p) if isinstance(p, str) else p[1] for p in self.pieces) + ")"


# A piece is a literal string or (zero-arg callable -> Column, SQL text); the
# callables keep SQL generation free of any Spark session.
def _num(col: str):
    return (lambda: F.col(col).cast("string"), f"CAST({col} AS VARCHAR)")


def _case(col: str, mod: int, values: list[str], offset: int = 0):
    """values[(col + offset) % mod] as a piece."""
    def sp():
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col(col) + offset, F.lit(mod)) + 1).cast("int"))
    sq = "[" + ", ".join(sql_str(v) for v in values) + f"][CAST(({col} + {offset}) % {mod} AS INTEGER) + 1]"
    return (sp, sq)


def _when(cond_spark, cond_sql: str, yes, no):
    def ys():
        return F.lit(yes) if isinstance(yes, str) else yes[0]()

    def ns():
        return F.lit(no) if isinstance(no, str) else no[0]()
    yq = sql_str(yes) if isinstance(yes, str) else yes[1]
    nq = sql_str(no) if isinstance(no, str) else no[1]
    return (lambda: F.when(cond_spark(), ys()).otherwise(ns()), f"(CASE WHEN {cond_sql} THEN {yq} ELSE {nq} END)")


def _mod(col, m, v):
    return (lambda: F.pmod(F.col(col), F.lit(m)) == v), f"{col} % {m} = {v}"


def _conf():
    return (lambda: F.lpad(F.pmod(F.col("review_id"), F.lit(100)).cast("string"), 2, "0"),
            "lpad(CAST(review_id % 100 AS VARCHAR), 2, '0')")


def _obj(retry: bool) -> Txt:
    """One response object; ``retry`` objects always carry idx and a changed sentiment."""
    seq = "review_seq"
    plain = Txt('"idx":', _num(seq), ",")
    if retry:
        idx = (plain.spark, plain.sql())
        sent = "Positive"
    else:
        high = Txt('"idx":', (lambda: (F.col(seq) + 100000).cast("string"), f"CAST({seq} + 100000 AS VARCHAR)"), ",")
        text = Txt('"idx":"', _num(seq), '",')
        idx = _when(*_mod(seq, 11, 0), "",
                    _when(*_mod(seq, 13, 0), '"idx":0,',
                          _when(*_mod(seq, 17, 0), (high.spark, high.sql()),
                                _when(*_mod(seq, 7, 0), (text.spark, text.sql()), (plain.spark, plain.sql())))))
        sent = (lambda: F.coalesce(F.col("lsent"), F.lit("Mixed")), "coalesce(lsent, 'Mixed')")
    rid = _num("review_id")

    def t(*pieces):
        x = Txt(*pieces)
        return (x.spark, x.sql())
    return Txt(
        "{", idx, '"sentiment":"', sent, '","themes":', _case("review_id", 3, ["[]", '"Driver\'s attitude"', '["Pricing","Reliability"]']),
        ',"priority":"P', (lambda: (F.pmod(F.col("review_id"), F.lit(4)) + 1).cast("string"), "CAST(review_id % 4 + 1 AS VARCHAR)"),
        '","churn_risk":"', _case("review_id", 3, ["Low", "Medium", "High"]), '"',
        ',"is_feature_request":', _when(*_mod("review_id", 4, 1), "true", "false"),
        ',"is_churn_signal":', _when(*_mod("review_id", 5, 2), "true", "false"),
        ',"trust_break":', _when(*_mod("review_id", 6, 3), "true", "false"),
        ',"action_item":', _when(*_mod("review_id", 4, 1), t('"Add export for item ', rid, '"'), "null"),
        ',"specific_issue":"', _when(*_mod("review_id", 2, 0), "", t("Issue ", rid)), '"',
        ',"churn_reason":', _when(*_mod("review_id", 5, 2), t('"Switching after item ', rid, '"'), "null"),
        ',"confidence":0.', _conf(), "}",
    )


_NUMBERED: dict = {}


def enrich_input(spark, sf):
    """Reviews to enrich: cleaned, length > 15, numbered 1.. per product.

    Numbering cuts lineage with a checkpoint (C8); the numbered frame is kept
    per (session, folder) so one query plan does not number the input twice.
    """
    key = (spark.sparkContext.applicationId, sf, input_state(spark, f"{sf.rstrip('/')}/documents.parquet"))
    if key not in _NUMBERED:
        r = C.min_length(clean_layer(spark, sf), FV.MIN_TEXT_LEN)
        _NUMBERED[key] = C.with_seq(r, ["product", "review_id"], group=["product"])
    return _NUMBERED[key]


ENRICH_INPUT_SQL = "seqd AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY review_id) AS review_seq FROM clean1)"
LAB_SQL = ("lab AS (SELECT doc_id AS review_id, CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' "
           "ELSE 'Neutral' END AS lsent FROM labels)")


def _file(prefix: str):
    def sp():
        # at least two digits, never truncated (b01 ... b99, b100 ...)
        return F.concat(F.lit(prefix), F.lower("product"), F.lit("_response_b"), F.format_string("%02d", F.col("batch_no")),
                        F.lit(".json"))
    sq = f"'{prefix}' || lower(product) || '_response_b' || printf('%02d', batch_no) || '.json'"
    return sp, sq


def responses(spark, sf):
    """Stand-in response files (file, body) derived from reviews and labels."""
    r = K.with_batches(enrich_input(spark, sf), BATCH)
    lab = table(spark, sf, "labels").select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, "Positive").otherwise("Neutral").alias("lsent"))
    o = r.join(lab, "review_id", "left").select("product", "batch_no", "pos", _obj(False).spark().alias("obj"),
                                                 _obj(True).spark().alias("robj"))

    def arr(c):
        return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", c))),
                                                             lambda x: x[c]), ","), F.lit("]"))
    b = o.groupBy("product", "batch_no").agg(arr("obj").alias("arr"), arr("robj").alias("rarr"))
    k = F.pmod("batch_no", F.lit(7))
    a = F.col("arr")
    body = (F.when(k == 0, a).when(k == 1, F.concat(F.lit("```json\n"), a, F.lit("\n```")))
            .when(k == 2, F.concat(F.lit('{"results":'), a, F.lit("}")))
            .when(k == 3, F.expr("substring(arr, 1, length(arr) - 20)"))
            .when(k == 4, F.expr("substring(arr, 1, length(arr) - 1)"))
            .when(k == 5, F.concat(a, F.lit(" done"))).otherwise(F.lit("sorry, no output")))
    first = b.select(_file("batches/")[0]().alias("file"), body.alias("body"))
    retry = b.filter(F.pmod("batch_no", F.lit(10)) == 3).select(_file("retry/")[0]().alias("file"), F.col("rarr").alias("body"))
    return first.unionByName(retry)


def responses_sql() -> str:
    return f""", {ENRICH_INPUT_SQL},
{LAB_SQL},
ob AS (SELECT s.product, s.review_id, s.review_seq, (s.review_seq - 1) // {BATCH} + 1 AS batch_no,
              (s.review_seq - 1) % {BATCH} + 1 AS pos, l.lsent FROM seqd s LEFT JOIN lab l ON l.review_id = s.review_id),
ob2 AS (SELECT product, batch_no, pos, {_obj(False).sql()} AS obj, {_obj(True).sql()} AS robj FROM ob),
bodies AS (SELECT product, batch_no, '[' || string_agg(obj, ',' ORDER BY pos) || ']' AS arr,
                  '[' || string_agg(robj, ',' ORDER BY pos) || ']' AS rarr FROM ob2 GROUP BY product, batch_no),
responses AS (
  SELECT {_file('batches/')[1]} AS file,
         CASE batch_no % 7 WHEN 0 THEN arr WHEN 1 THEN '```json' || chr(10) || arr || chr(10) || '```'
              WHEN 2 THEN '{{"results":' || arr || '}}' WHEN 3 THEN substr(arr, 1, length(arr) - 20)
              WHEN 4 THEN substr(arr, 1, length(arr) - 1) WHEN 5 THEN arr || ' done' ELSE 'sorry, no output' END AS body
  FROM bodies
  UNION ALL
  SELECT {_file('retry/')[1]}, rarr FROM bodies WHERE batch_no % 10 = 3)"""


# ---------------------------------------------------------------- parse (SQL)
def _sql_schema(obj: bool = True) -> str:
    fields = ", ".join(['"idx":"VARCHAR"'] + [f'"{f}":"JSON"' if f == "themes" else f'"{f}":"VARCHAR"'
                                              for f in FV.ENRICH_FIELDS])
    return "'{" + fields + "}'" if obj else "'[{" + fields + "}]'"


def _themes_sql(x: str) -> str:
    """Themes given as a JSON list or as text."""
    return f"(CASE json_type({x}) WHEN 'ARRAY' THEN from_json({x}, '[\"VARCHAR\"]') WHEN 'VARCHAR' THEN [{x} ->> '$'] END)"


WS = r"[\t\n\x0B\f\r ]"


def _strip_sql(x: str) -> str:
    from feedback_spark.plans.sql_base import trim_sql
    t = trim_sql(x)
    t = f"regexp_replace({t}, {sql_str('^```(?:json)?' + WS + '*')}, '')"
    t = f"regexp_replace({t}, {sql_str(WS + '*```$')}, '')"
    return trim_sql(t)


def parsed_sql() -> str:
    """CTEs ``parsed`` (one row per recovered object) over ``responses``."""
    arr, obj = _sql_schema(False), _sql_schema(True)
    key = "list_filter(json_keys(s), lambda k: json_type(s, '$.\"' || k || '\"') = 'ARRAY')[1]"
    suffixes = ["", "]", "\n]", ",null]"]
    fixes = " ".join(
        f"WHEN json_valid(c || {sql_str(sfx)}) AND json_type(c || {sql_str(sfx)}) = 'ARRAY' THEN c || {sql_str(sfx)}"
        for sfx in suffixes)
    fields = ", ".join(f"{_themes_sql('o.themes') if f == 'themes' else f'o.{f}'} AS {f}" for f in FV.ENRICH_FIELDS)
    return f""",
rs AS (SELECT file, regexp_extract(file, '([^/]+)_response_b\\d+\\.json$', 1) AS slug,
              TRY_CAST(regexp_extract(file, '_b(\\d+)\\.json$', 1) AS BIGINT) AS batch_no, {_strip_sql('body')} AS s FROM responses),
d1 AS (SELECT *, CASE WHEN left(s, 1) = '[' AND right(s, 1) = ']' AND json_valid(s) THEN from_json(s, {arr})
                      WHEN left(s, 1) = '{{' AND right(s, 1) = '}}' AND json_valid(s)
                      THEN from_json(json_extract(s, '$."' || {key} || '"'), {arr}) END AS objs FROM rs),
sv AS (SELECT *, CASE WHEN strpos(s, '[') > 0 THEN substr(s, strpos(s, '[')) END AS c FROM d1 WHERE objs IS NULL),
sv2 AS (SELECT *, CASE WHEN c IS NULL THEN NULL {fixes} END AS fixed FROM sv),
sv3 AS (SELECT file, slug, batch_no, s,
          CASE WHEN fixed IS NOT NULL
               THEN list_transform(list_filter(json_extract(fixed, '$[*]'), lambda e: json_type(e) = 'OBJECT'), lambda e: from_json(e, {obj}))
               WHEN c IS NOT NULL
               THEN list_transform(list_filter(regexp_extract_all(c, '\\{{[^{{}}]*\\}}'), lambda e: json_valid(e) AND json_type(e) = 'OBJECT'),
                                   lambda e: from_json(e, {obj}))
               ELSE [] END AS objs FROM sv2),
allp AS (SELECT file, slug, batch_no, s, objs, 'direct' AS method FROM d1 WHERE objs IS NOT NULL
         UNION ALL SELECT file, slug, batch_no, s, objs, CASE WHEN len(objs) > 0 THEN 'salvaged' ELSE 'none' END FROM sv3),
ex AS (SELECT file, slug, batch_no, method, unnest(objs) AS o, generate_subscripts(objs, 1) - 1 AS i FROM allp),
parsed AS (SELECT slug, file, batch_no, CAST(i AS BIGINT) AS i,
                  coalesce(TRY_CAST(o.idx AS BIGINT), (batch_no - 1) * {BATCH} + 1 + i) AS idx, method, {fields} FROM ex)"""


def _with(extra: str) -> str:
    from feedback_spark.plans.sql_base import with_base
    return with_base(responses_sql() + parsed_sql() + extra)


OUT_FIELDS = ["sentiment", "priority", "churn_risk", "action_item", "specific_issue", "churn_reason"]


def _k9(spark, sf):
    p = K.parse_responses(responses(spark, sf), BATCH)
    return p.select("slug", "file", "batch_no", "i", "idx", "method", *OUT_FIELDS,
                    F.concat_ws(" | ", "themes").alias("themes_text"),
                    *[F.col(f) for f in FV.ENRICH_BOOL_FIELDS if f in ("is_feature_request", "is_churn_signal", "trust_break")],
                    F.col("confidence").try_cast("double").alias("confidence"))


K9_SQL_SELECT = ("SELECT slug, file, batch_no, i, idx, method, " + ", ".join(OUT_FIELDS)
                 + ", coalesce(array_to_string(themes, ' | '), '') AS themes_text, is_feature_request, is_churn_signal, trust_break,"
                 " TRY_CAST(confidence AS DOUBLE) AS confidence FROM parsed")


def _totals(spark, sf):
    return enrich_input(spark, sf).groupBy(F.lower("product").alias("slug")).agg(F.count("*").alias("total"))


def _checked(spark, sf):
    return K.split_out_of_range(K.parse_responses(responses(spark, sf), BATCH), _totals(spark, sf))


CHECKED_SQL = """,
tot AS (SELECT lower(product) AS slug, count(*) AS total FROM seqd GROUP BY 1),
checked AS (SELECT p.*, t.total, coalesce(p.idx >= 1 AND p.idx <= t.total, false) AS in_range
            FROM parsed p LEFT JOIN tot t ON t.slug = p.slug),
win AS (SELECT * FROM checked WHERE in_range
        QUALIFY row_number() OVER (PARTITION BY slug, idx ORDER BY file DESC, i DESC) = 1)"""


def _winners(spark, sf):
    c = _checked(spark, sf)
    return K.last_write_wins(c.filter("in_range"))


def _merged(spark, sf):
    return K.merge_enrichment(enrich_input(spark, sf), _winners(spark, sf))


_ROUND_SQL = f"((review_seq - 1) // {BATCH}) % 2"


def _staged(spark, sf):
    """K19 as a deployment runs it: publish, then merge with the new rows (two thirds of the old are still wanted) and swap."""
    layer = os.path.join(work_dir(spark, "staged"), "enriched")
    m = _merged(spark, sf)
    half = F.pmod(F.floor((F.col("review_seq") - 1) / BATCH), F.lit(2))
    rows = lambda k: m.filter(half == k).select("product", "review_id", "review_text", "enrich_status", F.lit(k + 1).alias("published"))
    L.merge_publish(spark, layer, rows(0))
    L.merge_publish(spark, layer, rows(1), keep=m.filter(F.pmod("review_id", F.lit(3)) != 0))
    return L.read_layer(spark, layer).select("product", "review_id", "enrich_status", "published")


BOOL_SQL = {f: f"coalesce(lower(w.{f}) IN ('true', '1'), false)" for f in FV.ENRICH_BOOL_FIELDS}
MERGED_SQL = CHECKED_SQL + f""",
merged AS (
  SELECT s.*, w.file, w.i, w.method, w.sentiment AS llm_sentiment, w.priority, w.churn_risk, w.action_item, w.specific_issue,
         w.churn_reason, {', '.join(f'{v} AS {k}' for k, v in BOOL_SQL.items())},
         TRY_CAST(w.confidence AS DOUBLE) AS confidence, coalesce(array_to_string(w.themes, ' | '), '') AS themes_text,
         CASE WHEN w.file IS NOT NULL THEN 'parsed' ELSE 'missing' END AS enrich_status
  FROM seqd s LEFT JOIN win w ON w.slug = lower(s.product) AND w.idx = s.review_seq)"""

MERGED_COLS = ["product", "review_id", "review_seq", "enrich_status", "llm_sentiment", "priority", "churn_risk",
               "action_item", "specific_issue", "churn_reason", "themes_text", "confidence", *FV.ENRICH_BOOL_FIELDS]


def _answers(spark, sf):
    r = enrich_input(spark, sf)
    pieces = _answer_pieces()
    roles = F.array(*[F.struct(F.lit(role).alias("role"), t.spark().alias("answer")) for role, t in pieces.items()])
    x = r.select("product", "review_id", F.explode(roles).alias("a")).select("product", "review_id", "a.role", "a.answer")
    # a missing synthesis answer for every tenth review exercises the defaults
    return x.filter(~((F.col("role") == "synth") & (F.pmod("review_id", F.lit(10)) == 7)))


def _answer_pieces() -> dict:
    rid = _num("review_id")
    return {
        "pm": Txt('{"insight":"PM note ', rid, '","category":"', _case("review_id", 4, ["UX", "Pricing", "Reliability", "Performance"]),
                  '","severity":"', _case("review_id", 3, ["Low", "Medium", "High"]), '"}'),
        "cs": Txt('{"insight":"CS note ', rid, '","urgency":"', _case("review_id", 2, ["Low", "High"]), '","support_category":"Billing"}'),
        "growth": Txt('{"insight":"Growth note ', rid, '","churn_risk":"', _case("review_id", 3, ["Low", "Medium", "High"], 1),
                      '","growth_impact":"Low"}'),
        "skeptic": Txt(_when(*_mod("review_id", 9, 0), "{}",
                             (Txt('{"is_actionable":', _when(*_mod("review_id", 2, 0), "true", "false"), ',"reasoning":"Checked ', rid,
                                  '"}').spark,
                              Txt('{"is_actionable":', _when(*_mod("review_id", 2, 0), "true", "false"), ',"reasoning":"Checked ', rid,
                                  '"}').sql()))),
        "synth": Txt('{"final_category":"UX","priority":"', _case("review_id", 4, FV.PRIORITY_ROUTE_B), '","confidence":0.', _conf(),
                     ',"action_item":"Fix ', rid, '","key_insight":"Insight ', rid, '","sentiment":"',
                     _case("review_id", 3, ["Positive", "Negative", "Neutral"]), '"}'),
    }


def answers_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT product, review_id, '{role}' AS role, {t.sql()} AS answer FROM seqd"
        + (" WHERE review_id % 10 <> 7" if role == "synth" else "")
        for role, t in _answer_pieces().items())
    return f", {ENRICH_INPUT_SQL},\nanswers AS ({parts})"


def _agents_sql() -> str:
    roles = FV.AGENT_ROLES + ["synth"]
    piv = ", ".join(f"max(CASE WHEN role = '{r}' THEN answer END) AS {r}" for r in roles)

    def s(role, field):
        return f"coalesce(json_extract_string({role}, '$.{field}'), '')"
    cols = {
        "pm_insight": s("pm", "insight"), "pm_category": s("pm", "category"), "pm_severity": s("pm", "severity"),
        "cs_insight": s("cs", "insight"), "cs_urgency": s("cs", "urgency"), "cs_support_category": s("cs", "support_category"),
        "growth_insight": s("growth", "insight"), "churn_risk": s("growth", "churn_risk"), "growth_impact": s("growth", "growth_impact"),
        "is_actionable": "coalesce(CAST(json_extract(skeptic, '$.is_actionable') AS BOOLEAN), true)",
        "skeptic_reasoning": s("skeptic", "reasoning"), "final_category": s("synth", "final_category"),
        "priority": s("synth", "priority"), "confidence": "coalesce(CAST(json_extract(synth, '$.confidence') AS DOUBLE), 0.0)",
        "action_item": s("synth", "action_item"), "key_insight": s("synth", "key_insight"), "sentiment": s("synth", "sentiment"),
    }
    from feedback_spark.plans.sql_base import with_base
    return with_base(answers_sql() + f""",
wide AS (SELECT product, review_id, {piv} FROM answers GROUP BY product, review_id)
SELECT s.product, s.review_id, {', '.join(f'{v} AS {k}' for k, v in cols.items())}
FROM seqd s LEFT JOIN wide w ON w.product = s.product AND w.review_id = s.review_id""")


def _synth_sql() -> str:
    from feedback_spark.plans.sql_base import with_base
    piv = ", ".join(f"max(CASE WHEN role = '{r}' THEN answer END) AS {r}" for r in FV.AGENT_ROLES)
    op = "'{' || " + " || ',' || ".join(f"'\"{r}\":' || coalesce({r}, 'null')" for r in FV.AGENT_ROLES) + " || '}'"
    tpl = sql_str(K.SYNTH_TEMPLATE)
    return with_base(answers_sql() + f""",
wide AS (SELECT product, review_id, {piv} FROM answers GROUP BY product, review_id)
SELECT s.product, s.review_id,
       replace(replace(replace({tpl}, '{{product}}', s.product), '{{review}}', s.review_text), '{{answers}}', {op}) AS prompt
FROM seqd s LEFT JOIN wide w ON w.product = s.product AND w.review_id = s.review_id""")


def _agent_prompts_sql() -> str:
    from feedback_spark.plans.sql_base import with_base
    parts = " UNION ALL ".join(
        f"SELECT product, review_id, '{role}' AS role, replace(replace({sql_str(t)}, '{{product}}', product), '{{review}}', review_text) AS prompt FROM seqd"
        for role, t in K.AGENT_TEMPLATES.items())
    return with_base(f", {ENRICH_INPUT_SQL}\n{parts}")


def _prompts_sql(size: int, online: bool) -> str:
    from feedback_spark.plans.sql_base import trim_sql, with_base
    txt = trim_sql("review_text")
    pr = ", ".join(f"({sql_str(p)}, {sql_str(t)}, {sql_str(d)})" for p, t, d, _ in FV.PRODUCTS)
    if online:
        line = (f"'Review ' || CAST(pos AS VARCHAR) || ' [' || coalesce(platform, 'unknown') || "
                f"CASE WHEN rating IS NOT NULL THEN ' | Rating: ' || CAST(rating AS VARCHAR) || '★' ELSE '' END || ']:' || chr(10) || {txt}")
        return with_base(f""", {ENRICH_INPUT_SQL},
b AS (SELECT *, (review_seq - 1) // {size} + 1 AS batch_no, (review_seq - 1) % {size} + 1 AS pos FROM seqd),
g AS (SELECT product, batch_no, string_agg({line}, chr(10) || chr(10) ORDER BY pos) AS body, count(*) AS n_reviews,
             min(review_seq) AS first_seq, max(review_seq) AS last_seq FROM b GROUP BY product, batch_no),
pr(product, product_type, description) AS (VALUES {pr})
SELECT g.product, batch_no, n_reviews, first_seq, last_seq,
       'Product: ' || g.product || ' — ' || coalesce(pr.description, '') || chr(10) || chr(10) || chr(10) || body AS prompt
FROM g LEFT JOIN pr ON pr.product = g.product""")
    line = (f"'[' || CAST(review_seq AS VARCHAR) || '] [' || coalesce(platform, 'unknown') || "
            f"CASE WHEN rating IS NOT NULL THEN ' | ★' || CAST(CAST(trunc(rating) AS INTEGER) AS VARCHAR) ELSE '' END || "
            f"CASE WHEN date IS NOT NULL THEN ' | ' || substr(CAST(date AS VARCHAR), 1, 10) ELSE '' END || ']' || chr(10) || {txt} || chr(10)")
    voc = ", ".join(f"({sql_str(pt)}, {sql_str(FV.CATEGORY_VOCAB[pt])}, {sql_str(FV.SUPPORT_VOCAB[pt])})" for pt in FV.CATEGORY_VOCAB)
    return with_base(f""", {ENRICH_INPUT_SQL},
b AS (SELECT *, (review_seq - 1) // {size} + 1 AS batch_no, (review_seq - 1) % {size} + 1 AS pos FROM seqd),
g AS (SELECT product, batch_no, string_agg({line}, chr(10) ORDER BY pos) AS body, count(*) AS n_reviews,
             min(review_seq) AS first_seq, max(review_seq) AS last_seq FROM b GROUP BY product, batch_no),
tb AS (SELECT product, max(batch_no) AS total_batches FROM b GROUP BY product),
pr(product, product_type, description) AS (VALUES {pr}),
vc(product_type, categories, support) AS (VALUES {voc})
SELECT g.product, g.batch_no, n_reviews, first_seq, last_seq,
  'Annotate customer reviews of ' || g.product || ' (' || coalesce(pr.description, '') || ').' || chr(10)
  || 'Batch ' || CAST(g.batch_no AS VARCHAR) || ' of ' || CAST(tb.total_batches AS VARCHAR) || '; reviews '
  || CAST(first_seq AS VARCHAR) || '-' || CAST(last_seq AS VARCHAR) || '.' || chr(10)
  || 'Theme options: ' || vc.categories || chr(10) || 'Support categories: ' || vc.support || chr(10)
  || 'Return a JSON array of exactly ' || CAST(n_reviews AS VARCHAR) || ' objects, one per review, each with "idx" equal to the review number.'
  || chr(10) || '<reviews>' || chr(10) || body || '</reviews>' AS prompt
FROM g JOIN tb ON tb.product = g.product LEFT JOIN pr ON pr.product = g.product
LEFT JOIN vc ON vc.product_type = coalesce(pr.product_type, '{FV.DEFAULT_PRODUCT_TYPE}')""")


def _stats_sql() -> str:
    base = _prompts_sql(FV.OFFLINE_BATCH, False)
    words = f"len(list_filter(string_split_regex(prompt, {sql_str(SPACE + '+')}), lambda x: x <> ''))"
    return (f"SELECT product, batch_no, first_seq, last_seq, {words} AS words, "
            f"CAST(floor({words} * {FV.TOKENS_PER_WORD}) AS BIGINT) AS tokens_est FROM ({base})")


def _merged_q(fn):
    return lambda spark, sf: fn(_merged(spark, sf))


def _flagged_sql(flag: str, primary: str, n: int) -> str:
    return _with(MERGED_SQL + f"""
SELECT product, CAST(rank AS BIGINT) AS rank, review_id, snippet, CAST(1 AS BIGINT) AS n FROM (
  SELECT product, review_id,
         coalesce(nullif({primary}, ''), nullif(specific_issue, ''), substr(review_text, 1, {FV.SNIPPET_CHARS})) AS snippet,
         row_number() OVER (PARTITION BY product ORDER BY review_id) AS rank
  FROM merged WHERE {flag}) WHERE rank <= {n}""")


def _online_sql() -> str:
    arr = _sql_schema(False)
    key = ("list_filter(json_keys(s), lambda k: json_type(s, '$.\"' || k || '\"') = 'ARRAY' "
           "AND json_array_length(s, '$.\"' || k || '\"') = n)[1]")
    bools = ", ".join(f"coalesce(lower(o.{f}) IN ('true', '1'), false) AS {f}" for f in FV.ENRICH_BOOL_FIELDS)
    return _with(f""",
sizes AS (SELECT lower(product) AS slug, (review_seq - 1) // {BATCH} + 1 AS batch_no, count(*) AS n FROM seqd GROUP BY ALL),
ob1 AS (SELECT r.file, r.slug, r.batch_no, r.s, z.n FROM rs r JOIN sizes z ON z.slug = r.slug AND z.batch_no = r.batch_no),
ob3 AS (SELECT *, CASE WHEN left(s, 1) = '[' AND right(s, 1) = ']' AND json_valid(s) AND json_array_length(s) = n
                       THEN from_json(s, {arr})
                       WHEN left(s, 1) = '{{' AND right(s, 1) = '}}' AND json_valid(s)
                       THEN from_json(json_extract(s, '$."' || {key} || '"'), {arr}) END AS objs FROM ob1),
ox AS (SELECT slug, batch_no, file, unnest(objs) AS o, generate_subscripts(objs, 1) AS pos FROM ob3 WHERE objs IS NOT NULL),
ow AS (SELECT * FROM ox QUALIFY row_number() OVER (PARTITION BY slug, batch_no, pos ORDER BY file DESC) = 1),
inp AS (SELECT *, (review_seq - 1) // {BATCH} + 1 AS batch_no, (review_seq - 1) % {BATCH} + 1 AS pos FROM seqd)
SELECT i.product, i.review_id, i.batch_no, i.pos,
       CASE WHEN o.sentiment IS NOT NULL OR o.priority IS NOT NULL THEN 'parsed' ELSE 'missing' END AS enrich_status,
       o.sentiment AS sentiment, o.priority AS priority,
       CASE WHEN o.sentiment IS NOT NULL OR o.priority IS NOT NULL THEN coalesce(array_to_string({_themes_sql('o.themes')}, ' | '), '') ELSE '' END AS themes_text,
       {bools}
FROM inp i LEFT JOIN ow ON ow.slug = lower(i.product) AND ow.batch_no = i.batch_no AND ow.pos = i.pos""").replace(
        "o.sentiment", "ow.o.sentiment").replace("o.priority", "ow.o.priority").replace("o.themes", "ow.o.themes").replace(
        "lower(o.", "lower(ow.o.")


ONLINE_COLS = ["product", "review_id", "batch_no", "pos", "enrich_status", "sentiment", "priority", "themes_text",
               *FV.ENRICH_BOOL_FIELDS]

def _e4_llm(spark, sf):
    from feedback_spark.operators.themes import themes_wide
    m = _merged(spark, sf)
    out = themes_wide(m, llm_col="themes_text")
    return out.select("product", "review_id", *[c for c in out.columns if c.startswith("theme_")])


def _e4_llm_sql() -> str:
    known = list(dict.fromkeys(t for lst in FV.THEME_PATTERNS.values() for t, _ in lst))
    extra = [t for t in sorted(["Driver's attitude", "Pricing", "Reliability"]) if t not in known]
    cols = ", ".join(f"list_contains(lt, {sql_str(t)}) AS \"theme_{t}\"" for t in known + extra)
    return _with(MERGED_SQL + f""",
ml AS (SELECT product, review_id, CASE WHEN themes_text IS NULL OR themes_text = '' THEN []::VARCHAR[]
                                       ELSE string_split_regex(themes_text, '[\\t ]*\\|[\\t ]*') END AS lt FROM merged)
SELECT product, review_id, {cols} FROM ml""")


def _e4_flags(spark, sf):
    from feedback_spark.operators.themes import theme_flags
    out = theme_flags(_merged(spark, sf), llm_col="themes_text")
    return out.select("product", "review_id", F.explode("theme_flags").alias("theme", "flag"))


def _e4_flags_sql() -> str:
    known = list(dict.fromkeys(t for lst in FV.THEME_PATTERNS.values() for t, _ in lst))
    rows = ", ".join(f"({sql_str(t)})" for t in known)
    return _with(MERGED_SQL + f""",
ml AS (SELECT product, review_id, CASE WHEN themes_text IS NULL OR themes_text = '' THEN []::VARCHAR[]
                                       ELSE string_split_regex(themes_text, '[\\t ]*\\|[\\t ]*') END AS lt FROM merged),
own AS (SELECT DISTINCT product, review_id, t AS theme FROM (SELECT product, review_id, unnest(lt) AS t FROM ml) WHERE t <> ''),
known AS (SELECT theme FROM (VALUES {rows}) v(theme))
SELECT ml.product, ml.review_id, known.theme, list_contains(ml.lt, known.theme) AS flag FROM ml, known
UNION ALL
SELECT product, review_id, theme, TRUE AS flag FROM own WHERE theme NOT IN (SELECT theme FROM known)""")


QUERIES = {
    "e4_themes_wide_llm": (_e4_llm, _e4_llm_sql()),
    "e4_theme_flags": (_e4_flags, _e4_flags_sql()),
    "k9_online_route": (
        lambda spark, sf: K.online_results(K.with_batches(enrich_input(spark, sf), BATCH), responses(spark, sf))
        .select(*ONLINE_COLS),
        _online_sql(),
    ),
    "k1_with_batches": (
        lambda spark, sf: K.with_batches(enrich_input(spark, sf), FV.OFFLINE_BATCH)
        .select("product", "review_id", "review_seq", "batch_no", "pos"),
        _with(f"""
SELECT product, review_id, review_seq, (review_seq - 1) // {FV.OFFLINE_BATCH} + 1 AS batch_no,
       (review_seq - 1) % {FV.OFFLINE_BATCH} + 1 AS pos FROM seqd"""),
    ),
    "k2_batch_prompts": (
        lambda spark, sf: K.batch_prompts(enrich_input(spark, sf), products(spark), FV.ONLINE_BATCH),
        _prompts_sql(FV.ONLINE_BATCH, True),
    ),
    "k3_offline_prompts": (
        lambda spark, sf: K.offline_prompts(enrich_input(spark, sf), products(spark), FV.OFFLINE_BATCH),
        _prompts_sql(FV.OFFLINE_BATCH, False),
    ),
    "k4_prompt_stats": (
        lambda spark, sf: K.prompt_stats(K.offline_prompts(enrich_input(spark, sf), products(spark), FV.OFFLINE_BATCH)),
        _stats_sql(),
    ),
    "k5_agent_prompts": (lambda spark, sf: K.agent_prompts(enrich_input(spark, sf)), _agent_prompts_sql()),
    "k6_synthesis_prompts": (lambda spark, sf: K.synthesis_prompts(enrich_input(spark, sf), _answers(spark, sf)), _synth_sql()),
    "k7_assemble_agents": (lambda spark, sf: K.assemble_agents(enrich_input(spark, sf), _answers(spark, sf)), _agents_sql()),
    "k8_between_fences": (
        lambda spark, sf: responses(spark, sf).select("file", between_fences("body").alias("stripped")),
        _with(f"""
SELECT file, CASE WHEN starts_with(t, '```') THEN {trim_sql("regexp_replace(split_part(t, '```', 2), '^json', '')")} ELSE t END AS stripped
FROM (SELECT file, {trim_sql("body")} AS t FROM responses)"""),
    ),
    "k8_strip_fences": (
        lambda spark, sf: responses(spark, sf).select("file", K.strip_fences("body").alias("stripped")),
        _with(f"\nSELECT file, {_strip_sql('body')} AS stripped FROM responses"),
    ),
    "k9_parse_responses": (_k9, _with("\n" + K9_SQL_SELECT)),
    "k13_out_of_range": (
        lambda spark, sf: _checked(spark, sf).select("slug", "file", "i", "idx", "in_range"),
        _with(CHECKED_SQL + "\nSELECT slug, file, i, idx, in_range FROM checked"),
    ),
    "k14_last_write_wins": (
        lambda spark, sf: _winners(spark, sf).select("slug", "idx", "file", "i", "sentiment"),
        _with(CHECKED_SQL + "\nSELECT slug, idx, file, i, sentiment FROM win"),
    ),
    "k15_merge_enrichment": (
        _merged_q(lambda m: m.select(*MERGED_COLS)),
        _with(MERGED_SQL + "\nSELECT " + ", ".join(MERGED_COLS) + " FROM merged"),
    ),
    "k17_default_enrichment": (
        _merged_q(lambda m: K.default_enrichment(m).select("product", "review_id", "enrich_status", "themes_text",
                                                           *FV.ENRICH_BOOL_FIELDS)),
        _with(MERGED_SQL + "\nSELECT product, review_id, enrich_status, themes_text, "
              + ", ".join(f"CASE WHEN enrich_status = 'missing' THEN false ELSE {f} END AS {f}" for f in FV.ENRICH_BOOL_FIELDS)
              + " FROM merged"),
    ),
    "k18_pending": (
        lambda spark, sf: K.pending(enrich_input(spark, sf), _merged(spark, sf)).select("product", "review_id"),
        _with(MERGED_SQL + """
SELECT product, review_id FROM seqd s WHERE NOT EXISTS (
  SELECT 1 FROM merged m WHERE m.enrich_status = 'parsed' AND m.product = s.product AND m.review_text = s.review_text)"""),
    ),
    "k19_merge_incremental": (
        _merged_q(lambda m: K.merge_incremental(
            m.filter(F.pmod(F.floor((F.col("review_seq") - 1) / BATCH), F.lit(2)) == 0),
            m.filter(F.pmod(F.floor((F.col("review_seq") - 1) / BATCH), F.lit(2)) == 1)).select("product", "review_id", "enrich_status")),
        _with(MERGED_SQL + "\nSELECT product, review_id, enrich_status FROM merged"),
    ),
    "k19_staged_publish": (
        _staged,
        _with(MERGED_SQL + f"""
SELECT product, review_id, enrich_status, CASE WHEN {_ROUND_SQL} = 0 THEN 1 ELSE 2 END AS published
FROM merged WHERE {_ROUND_SQL} > 0 OR review_id % 3 <> 0"""),
    ),
    "k20_coverage": (
        lambda spark, sf: K.coverage(enrich_input(spark, sf), _checked(spark, sf)),
        _with(CHECKED_SQL + """
SELECT s.product, count(*) AS total, coalesce(max(c.parsed), 0) AS parsed, coalesce(max(c.skipped), 0) AS skipped,
       count(*) - coalesce(max(c.covered), 0) AS missing
FROM seqd s LEFT JOIN (SELECT slug, CAST(sum(CASE WHEN in_range THEN 1 ELSE 0 END) AS BIGINT) AS parsed,
                              CAST(sum(CASE WHEN in_range THEN 0 ELSE 1 END) AS BIGINT) AS skipped,
                              count(DISTINCT CASE WHEN in_range THEN idx END) AS covered FROM checked GROUP BY slug) c
  ON c.slug = lower(s.product)
GROUP BY s.product"""),
    ),
    "k21_zip_batches": (
        lambda spark, sf: K.zip_batches(K.with_batches(enrich_input(spark, sf), BATCH),
                                        K.parse_responses(responses(spark, sf), BATCH))
        .select("product", "review_id", "batch_no", "pos", "file", "idx"),
        _with("""
SELECT s.product, s.review_id, s.batch_no, s.pos, p.file, p.idx
FROM (SELECT *, (review_seq - 1) // 5 + 1 AS batch_no, (review_seq - 1) % 5 + 1 AS pos FROM seqd) s
JOIN parsed p ON p.slug = lower(s.product) AND p.batch_no = s.batch_no AND p.i + 1 = s.pos"""),
    ),
    "h15_breakdowns": (
        _merged_q(lambda m: M.breakdowns(m.withColumn("sentiment", F.col("llm_sentiment"))
                                         .withColumn("priority", F.substring("priority", 1, 2)))),
        _with(MERGED_SQL + """
SELECT product, field, value, count(*) AS n FROM (
  SELECT product, 'priority' AS field, substr(priority, 1, 2) AS value FROM merged
  UNION ALL SELECT product, 'sentiment', llm_sentiment FROM merged
  UNION ALL SELECT product, 'churn_risk', churn_risk FROM merged) WHERE value IS NOT NULL GROUP BY ALL"""),
    ),
    "h16_flag_totals": (
        _merged_q(M.flag_totals),
        _with(MERGED_SQL + "\nSELECT product, " + ", ".join(
            f"CAST(sum(CASE WHEN lower(CAST({f} AS VARCHAR)) IN ('true', '1') THEN 1 ELSE 0 END) AS BIGINT) AS {f}"
            for f in FV.ENRICH_BOOL_FIELDS) + " FROM merged GROUP BY product"),
    ),
    "g2_flagged_requests": (
        _merged_q(lambda m: G.flagged_requests(m).select("product", "rank", "review_id", "snippet", "n")),
        _flagged_sql("is_feature_request", "action_item", 6),
    ),
    "g4_flagged_churn": (
        _merged_q(lambda m: G.flagged_churn(m).select("product", "rank", "review_id", "snippet", "n")),
        _flagged_sql("is_churn_signal", "churn_reason", 4),
    ),
}
