"""K: enrichment dataflow around an external model (the call itself excluded).

Batching, prompt assembly, response parsing with damaged-JSON recovery, index
resolution, last-write-wins, the merge back into reviews, resume and
incremental merge, and the agent route's fan-out / synthesis / assembly.

Responses arrive as a table ``(file, body)``.  Parsing takes a native fast
path (``from_json`` on bodies that look complete); only the rejected
remainder goes through the Arrow salvage function (suffix repair, then a
string-aware brace scan), so Python touches only damaged files.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import SPACE
from feedback_spark.functions.text import clean_text, flatten_themes, strip_fences, truthy

P = "product"

# Response object schema: scalar fields are read as text (an INT field holding
# "2" would become null); themes too, since they come as a list or as text.
OBJ_SCHEMA = "struct<idx:string," + ",".join(f"{f}:string" for f in FV.ENRICH_FIELDS) + ">"
ARR_SCHEMA = f"array<{OBJ_SCHEMA}>"


def theme_list(col: str | Column) -> Column:
    """Themes of a response: a JSON list as it is, any other text as one theme, empty or null as null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.startswith("["), F.from_json(c, "array<string>")).when(c != "", F.array(c))


def _response_fields(prefix: str) -> list[Column]:
    return [(theme_list(f"{prefix}.{f}") if f == "themes" else F.col(f"{prefix}.{f}")).alias(f) for f in FV.ENRICH_FIELDS]


# ---------------------------------------------------------------- batching
def with_batches(r: DataFrame, size: int, seq: str = "review_seq") -> DataFrame:
    """K1: fixed-size batches in row order: batch_no (1-based) and pos (1-based)."""
    return (r.withColumn("batch_no", F.floor((F.col(seq) - 1) / size).cast("long") + 1)
            .withColumn("pos", F.pmod(F.col(seq) - 1, F.lit(size)).cast("long") + 1))


def _prompt_text(max_chars: int | None) -> Column:
    """The trimmed text, whole unless a limit is asked for (``FV.PROMPT_TEXT_CHARS`` is the original's)."""
    t = clean_text("review_text")
    return t if max_chars is None else F.substring(t, 1, max_chars)


def _collect_lines(df: DataFrame, keys: list[str], order: str, line: Column, sep: str) -> DataFrame:
    # a batch holds at most `size` rows (5 or 150): bounded collect per group
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))),
                                 lambda x: x["l"]), sep).alias("_body"),
        F.count("*").alias("n_reviews"), F.min("review_seq").alias("first_seq"), F.max("review_seq").alias("last_seq"))


def batch_prompts(r: DataFrame, products: DataFrame, size: int = FV.ONLINE_BATCH,
                  max_chars: int | None = None) -> DataFrame:
    """K2: online prompt per batch: product header, then numbered reviews."""
    b = with_batches(r, size)
    rating = F.when(F.col("rating").isNotNull(), F.concat(F.lit(" | Rating: "), F.col("rating").cast("string"), F.lit("★"))).otherwise("")
    line = F.concat(F.lit("Review "), F.col("pos").cast("string"), F.lit(" ["), F.coalesce("platform", F.lit("unknown")), rating,
                    F.lit("]:\n"), _prompt_text(max_chars))
    body = _collect_lines(b, [P, "batch_no"], "pos", line, "\n\n")
    head = F.concat(F.lit("Product: "), F.col(P), F.lit(" — "), F.coalesce("description", F.lit("")), F.lit("\n"))
    return (body.join(products.select(P, "description"), P, "left")
            .select(P, "batch_no", "n_reviews", "first_seq", "last_seq", F.concat(head, F.lit("\n\n"), "_body").alias("prompt")))


def offline_prompts(r: DataFrame, products: DataFrame, size: int = FV.OFFLINE_BATCH,
                    max_chars: int | None = None) -> DataFrame:
    """K3: offline prompt per batch: instructions with the product type's
    vocabularies and the batch's count, then reviews numbered globally."""
    b = with_batches(r, size)
    rating = F.when(F.col("rating").isNotNull(), F.concat(F.lit(" | ★"), F.col("rating").cast("int").cast("string"))).otherwise("")
    date = F.when(F.col("date").isNotNull(), F.concat(F.lit(" | "), F.substring(F.col("date").cast("string"), 1, 10))).otherwise("")
    line = F.concat(F.lit("["), F.col("review_seq").cast("string"), F.lit("] ["), F.coalesce("platform", F.lit("unknown")),
                    rating, date, F.lit("]\n"), _prompt_text(max_chars), F.lit("\n"))
    body = _collect_lines(b, [P, "batch_no"], "pos", line, "\n")
    totals = b.groupBy(P).agg(F.max("batch_no").alias("total_batches"))  # one row per product
    vocab = vocab_table(r.sparkSession)
    ptype = F.coalesce(F.col("product_type"), F.lit(FV.DEFAULT_PRODUCT_TYPE))
    x = (body.join(totals, P).join(products.select(P, "product_type", "description"), P, "left")
         .withColumn("product_type", ptype).join(F.broadcast(vocab), "product_type", "left"))
    head = F.concat(
        F.lit("Annotate customer reviews of "), F.col(P), F.lit(" ("), F.coalesce("description", F.lit("")), F.lit(").\n"),
        F.lit("Batch "), F.col("batch_no").cast("string"), F.lit(" of "), F.col("total_batches").cast("string"),
        F.lit("; reviews "), F.col("first_seq").cast("string"), F.lit("-"), F.col("last_seq").cast("string"), F.lit(".\n"),
        F.lit("Theme options: "), F.col("categories"), F.lit("\nSupport categories: "), F.col("support"),
        F.lit("\nReturn a JSON array of exactly "), F.col("n_reviews").cast("string"),
        F.lit(" objects, one per review, each with \"idx\" equal to the review number.\n<reviews>\n"))
    return x.select(P, "batch_no", "n_reviews", "first_seq", "last_seq",
                    F.concat(head, F.col("_body"), F.lit("</reviews>")).alias("prompt"))


def vocab_table(spark) -> DataFrame:
    """Category vocabularies per product type (broadcast dimension)."""
    rows = [(pt, FV.CATEGORY_VOCAB[pt], FV.SUPPORT_VOCAB[pt]) for pt in FV.CATEGORY_VOCAB]
    return spark.createDataFrame(rows, "product_type string, categories string, support string")


def prompt_stats(prompts: DataFrame) -> DataFrame:
    """K4: whitespace words, token estimate trunc(1.35 * words), review range."""
    words = F.size(F.filter(F.split(F.col("prompt"), f"{SPACE}+"), lambda x: x != ""))
    return prompts.select(P, "batch_no", "first_seq", "last_seq", words.alias("words"),
                          F.floor(words * FV.TOKENS_PER_WORD).cast("long").alias("tokens_est"))


# ---------------------------------------------------------------- agent route
AGENT_TEMPLATES = {
    "pm": "As product manager for {product}, name the product gap in this review as JSON "
          "(insight, category, severity).\nReview: {review}",
    "cs": "As support lead for {product}, judge urgency of this review as JSON "
          "(insight, urgency, support_category).\nReview: {review}",
    "growth": "As growth analyst for {product}, judge churn risk of this review as JSON "
              "(insight, churn_risk, growth_impact).\nReview: {review}",
    "skeptic": "As a skeptic, decide whether this review about {product} is actionable as JSON "
               "(is_actionable, reasoning).\nReview: {review}",
}
SYNTH_TEMPLATE = ("Reconcile four opinions about one review of {product} into JSON (final_category, priority, "
                  "confidence, action_item, key_insight, sentiment).\nReview: {review}\nOpinions: {answers}")


def agent_prompts(r: DataFrame, templates: dict | None = None) -> DataFrame:
    """K5: review x role prompts by a narrow explode of a fixed role list (4N rows)."""
    templates = templates or AGENT_TEMPLATES
    roles = F.array(*[F.struct(F.lit(k).alias("role"), F.lit(v).alias("tpl")) for k, v in templates.items()])
    x = r.select(P, "review_id", "review_text", F.explode(roles).alias("t"))
    prompt = F.replace(F.replace(F.col("t.tpl"), F.lit("{product}"), F.col(P)), F.lit("{review}"), F.col("review_text"))
    return x.select(P, "review_id", F.col("t.role").alias("role"), prompt.alias("prompt"))


def pivot_answers(answers: DataFrame, roles: list[str] | None = None) -> DataFrame:
    """(product, review_id, role, answer) -> one row per review, one column per role."""
    roles = roles or FV.AGENT_ROLES
    return answers.groupBy(P, "review_id").pivot("role", roles).agg(F.first("answer"))


def synthesis_prompts(r: DataFrame, answers: DataFrame, template: str = SYNTH_TEMPLATE) -> DataFrame:
    """K6: synthesis prompt from the four role answers (raw JSON kept verbatim)."""
    wide = pivot_answers(answers)
    opinions = F.concat(F.lit("{"), *[
        x for i, role in enumerate(FV.AGENT_ROLES)
        for x in ([F.lit(",")] if i else []) + [F.lit(f'"{role}":'), F.coalesce(F.col(role), F.lit("null"))]
    ], F.lit("}"))
    x = r.select(P, "review_id", "review_text").join(wide, [P, "review_id"], "left")
    prompt = F.replace(F.replace(F.replace(F.lit(template), F.lit("{product}"), F.col(P)),
                                 F.lit("{review}"), F.col("review_text")), F.lit("{answers}"), opinions)
    return x.select(P, "review_id", prompt.alias("prompt"))


_AGENT_JSON = {
    "pm": "struct<insight:string,category:string,severity:string>",
    "cs": "struct<insight:string,urgency:string,support_category:string>",
    "growth": "struct<insight:string,churn_risk:string,growth_impact:string>",
    "skeptic": "struct<is_actionable:boolean,reasoning:string>",
    "synth": "struct<final_category:string,priority:string,confidence:double,action_item:string,key_insight:string,sentiment:string>",
}


def assemble_agents(r: DataFrame, answers: DataFrame) -> DataFrame:
    """K7: five answers -> 17 columns; strings default '', is_actionable true, confidence 0."""
    wide = pivot_answers(answers, FV.AGENT_ROLES + ["synth"])
    x = r.select(P, "review_id").join(wide, [P, "review_id"], "left")
    parsed = {k: F.from_json(F.col(k), s) for k, s in _AGENT_JSON.items()}

    def s(role, field):
        return F.coalesce(parsed[role][field], F.lit(""))
    cols = {
        "pm_insight": s("pm", "insight"), "pm_category": s("pm", "category"), "pm_severity": s("pm", "severity"),
        "cs_insight": s("cs", "insight"), "cs_urgency": s("cs", "urgency"), "cs_support_category": s("cs", "support_category"),
        "growth_insight": s("growth", "insight"), "churn_risk": s("growth", "churn_risk"),
        "growth_impact": s("growth", "growth_impact"),
        "is_actionable": F.coalesce(parsed["skeptic"]["is_actionable"], F.lit(True)),
        "skeptic_reasoning": s("skeptic", "reasoning"), "final_category": s("synth", "final_category"),
        "priority": s("synth", "priority"), "confidence": F.coalesce(parsed["synth"]["confidence"], F.lit(0.0)),
        "action_item": s("synth", "action_item"), "key_insight": s("synth", "key_insight"),
        "sentiment": s("synth", "sentiment"),
    }
    return x.select(P, "review_id", *[cols[f].alias(f) for f in FV.AGENT_FIELDS])


# ---------------------------------------------------------------- responses
_DECODER = json.JSONDecoder()


def _salvage(body: str | None) -> list[str] | None:
    """K10 + K11: every complete object of a damaged array, in order.

    The decoder reads one value from each brace after the first bracket; it
    knows about strings and nesting, so what is left over is only text between
    objects and an object that the end of the body cuts off.
    """
    if body is None:
        return None
    found: list[str] = []
    at = body.find("[")
    while at >= 0 and (at := body.find("{", at)) >= 0:
        try:
            value, end = _DECODER.raw_decode(body, at)
        except ValueError:
            end = _past_broken_object(body, at)
            value = None
        if isinstance(value, dict):
            found.append(json.dumps(value))
        at = end
    return found


def _past_broken_object(body: str, at: int) -> int:
    """Where to go on after an object that does not parse: its closing brace, or the end if there is none."""
    for m in _TOKENS.finditer(body, at):
        if m[0] == "{":
            depth = depth + 1 if m.start() > at else 1
        elif m[0] == "}":
            depth -= 1
            if depth == 0:
                return m.end()
    return len(body)


#: A string (also one that never ends) or a brace outside strings.
_TOKENS = re.compile(r'"(?:[^"\\]|\\.)*(?:"|$)|[{}]', re.S)


def _salvage_batch(bodies: pa.Array) -> pa.Array:
    return pa.array([_salvage(b) for b in bodies.to_pylist()], pa.list_(pa.string()))


def salvage_objects(col: Column) -> Column:
    """K10 + K11 as an Arrow-batched function (created on the driver only)."""
    return F.arrow_udf(_salvage_batch, "array<string>")(col)


def parse_responses(raw: DataFrame, size: int = FV.OFFLINE_BATCH) -> DataFrame:
    """K8-K12 over a (file, body) response table (A5): one row per recovered object.

    Output: slug, file, batch_no, i (0-based position), idx, method, and the
    response fields.
    """
    base = raw.select(
        "file",
        F.regexp_extract("file", r"([^/]+)_response_b\d+\.json$", 1).alias("slug"),
        F.regexp_extract("file", r"_b(\d+)\.json$", 1).try_cast("long").alias("batch_no"),
        strip_fences("body").alias("s"),
    )
    first, last = F.substring("s", 1, 1), F.substring(F.col("s"), -1, 1)
    direct_arr = F.when((first == "[") & (last == "]"), F.from_json("s", ARR_SCHEMA))
    as_map = F.from_json("s", "map<string,string>")
    first_list = F.try_element_at(F.filter(F.map_values(as_map), lambda v: v.startswith("[")), F.lit(1))
    direct_obj = F.when((first == "{") & (last == "}"), F.from_json(first_list, ARR_SCHEMA))
    from feedback_spark.session import ship_package

    ship_package(raw.sparkSession)
    # one pass: a body that parses directly crosses to Python as null only
    x = base.withColumn("direct", F.coalesce(direct_arr, direct_obj))
    x = x.withColumn("_txt", salvage_objects(F.when(F.col("direct").isNull(), F.col("s"))))
    rest = F.transform(F.coalesce("_txt", F.array().cast("array<string>")), lambda o: F.from_json(o, OBJ_SCHEMA))
    x = x.withColumn("objs", F.coalesce("direct", rest)).withColumn("method", F.when(F.col("direct").isNotNull(), "direct").otherwise("salvaged"))
    # an expression, not the bare column, for which the optimizer would filter on the salvaged objects at the scan, and so salvage twice
    objs = x.select("slug", "file", "batch_no", "method", F.posexplode(F.transform("objs", lambda o: o)).alias("i", "o"))
    idx = F.coalesce(F.col("o.idx").try_cast("int").cast("long"), (F.col("batch_no") - 1) * size + 1 + F.col("i"))
    return objs.select("slug", "file", "batch_no", F.col("i").cast("long").alias("i"), idx.alias("idx"), "method",
                       *_response_fields("o"))


def online_results(inputs: DataFrame, raw: DataFrame) -> DataFrame:
    """Online (batch-of-5) route: K8 + K9 strict, K21, K17.

    A response is accepted only when it parses directly (no salvage) and
    holds exactly as many objects as its batch has reviews (a wrapped object
    contributes its first list of that length).  Accepted objects are matched
    to the batch's reviews by position; every review of a rejected batch
    gets the default enrichment.
    """
    sizes = inputs.groupBy(F.lower(P).alias("slug"), "batch_no").agg(F.count("*").alias("n"))  # one row per batch
    base = raw.select(
        F.regexp_extract("file", r"([^/]+)_response_b\d+\.json$", 1).alias("slug"),
        F.regexp_extract("file", r"_b(\d+)\.json$", 1).try_cast("long").alias("batch_no"),
        "file", strip_fences("body").alias("s")).join(sizes, ["slug", "batch_no"])
    first, last = F.substring("s", 1, 1), F.substring(F.col("s"), -1, 1)
    arr = F.when((first == "[") & (last == "]"), F.from_json("s", ARR_SCHEMA))
    lists = F.transform(F.filter(F.map_values(F.from_json("s", "map<string,string>")), lambda v: v.startswith("[")),
                        lambda v: F.from_json(v, ARR_SCHEMA))
    wrapped = F.when((first == "{") & (last == "}"),
                     F.try_element_at(F.filter(lists, lambda a: F.size(a) == F.col("n")), F.lit(1)))
    objs = F.when(F.size(arr) == F.col("n"), arr).otherwise(wrapped)
    ok = (base.select("slug", "batch_no", "file", objs.alias("objs")).filter(F.col("objs").isNotNull())
          .select("slug", "batch_no", "file", F.posexplode("objs").alias("i", "o"))
          .select("slug", "batch_no", "file", (F.col("i") + 1).alias("pos"), *_response_fields("o")))
    # several files for one batch: the last file name wins (bounded: files per batch)
    ok = ok.groupBy("slug", "batch_no", "pos").agg(F.max_by(F.struct(*[F.col(f) for f in FV.ENRICH_FIELDS]), "file").alias("w")) \
        .select("slug", "batch_no", "pos", "w.*")
    x = inputs.withColumn("slug", F.lower(P)).join(ok, ["slug", "batch_no", "pos"], "left").drop("slug")
    x = x.withColumn("enrich_status", F.when(F.col("sentiment").isNotNull() | F.col("priority").isNotNull(), "parsed")
                     .otherwise("missing"))
    x = typed_enrichment(x).withColumn("themes_text", flatten_themes("themes"))
    return default_enrichment(x)


def split_out_of_range(parsed: DataFrame, totals: DataFrame) -> DataFrame:
    """Flag rows whose idx is outside 1..total of their product (``in_range``)."""
    return parsed.join(totals, "slug", "left").withColumn(
        "in_range", F.coalesce((F.col("idx") >= 1) & (F.col("idx") <= F.col("total")), F.lit(False)))


def last_write_wins(parsed: DataFrame) -> DataFrame:
    """One object per (slug, idx): the latest by (file name, position)."""
    fields = ["file", "i", "method", *FV.ENRICH_FIELDS]
    agg = parsed.groupBy("slug", "idx").agg(
        F.max_by(F.struct(*fields), F.struct("file", "i")).alias("w"))
    return agg.select("slug", "idx", *[F.col(f"w.{f}").alias(f) for f in fields])


def typed_enrichment(df: DataFrame) -> DataFrame:
    """Cast response text fields: flags to boolean, confidence to double."""
    out = df
    for f in FV.ENRICH_BOOL_FIELDS:
        out = out.withColumn(f, truthy(f))
    return out.withColumn("confidence", F.col("confidence").try_cast("double"))


def merge_enrichment(r: DataFrame, winners: DataFrame, seq: str = "review_seq") -> DataFrame:
    """K15 + K16: reviews LEFT JOIN winners on (product, seq = idx); themes flattened."""
    x = r.withColumn("slug", F.lower(F.col(P))).join(
        winners.withColumnRenamed("idx", seq).withColumnRenamed("sentiment", "llm_sentiment"), ["slug", seq], "left")
    x = typed_enrichment(x).withColumn("themes_text", flatten_themes("themes"))
    return x.withColumn("enrich_status", F.when(F.col("file").isNotNull(), "parsed").otherwise("missing")).drop("slug")


def default_enrichment(r: DataFrame) -> DataFrame:
    """Rows without enrichment get null strings, an empty theme list, false flags."""
    missing = F.col("enrich_status") == "missing"
    out = r
    for f in FV.ENRICH_BOOL_FIELDS:
        out = out.withColumn(f, F.when(missing, F.lit(False)).otherwise(F.col(f)))
    return out.withColumn("themes_text", F.when(missing, F.lit("")).otherwise(F.col("themes_text")))


def text_key(col: str = "review_text") -> Column:
    """128-bit digest of a text (null: null): what joins on texts compare and shuffle."""
    return F.unhex(F.md5(F.col(col)))


def pending(r: DataFrame, done: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Reviews whose text is not enriched yet (left anti on product + text).

    ``retry_failed=False`` reproduces the original resume, which counted
    failed (defaulted) rows as done and never retried them.
    """
    d = done.filter(F.col("enrich_status") == "parsed") if retry_failed else done
    seen = d.select(P, text_key().alias("_key")).distinct()
    return r.withColumn("_key", text_key()).join(seen, [P, "_key"], "left_anti").drop("_key")


def merge_incremental(done: DataFrame, new: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """Earlier rows still wanted (left semi on ``keep``) plus the new rows."""
    wanted = done if keep is None else done.withColumn("_key", text_key()).join(
        keep.select(P, text_key().alias("_key")).distinct(), [P, "_key"], "left_semi").drop("_key")
    return wanted.unionByName(new, allowMissingColumns=True)


def coverage(r: DataFrame, checked: DataFrame) -> DataFrame:
    """Per product: parsed objects, skipped (out of range), missing rows."""
    totals = r.groupBy(P).agg(F.count("*").alias("total")).withColumn("slug", F.lower(P))
    c = checked.groupBy("slug").agg(
        F.sum(F.col("in_range").cast("int")).cast("long").alias("parsed"),
        F.sum((~F.col("in_range")).cast("int")).cast("long").alias("skipped"),
        F.countDistinct(F.when(F.col("in_range"), F.col("idx"))).alias("_covered"))
    return (totals.join(c, "slug", "left").na.fill(0, ["parsed", "skipped", "_covered"])
            .select(P, "total", "parsed", "skipped", (F.col("total") - F.col("_covered")).alias("missing")))


def zip_batches(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Positional join of batch inputs (batch_no, pos) with outputs (batch_no, i + 1)."""
    o = outputs.withColumn("pos", F.col("i") + 1)
    return inputs.withColumn("slug", F.lower(P)).join(o, ["slug", "batch_no", "pos"]).drop("slug")

