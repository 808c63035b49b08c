"""Registered queries of this subpackage: name -> (function(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark.llm.common import fold, materialise, table
from feedback_spark.llm import language_id
from feedback_spark.llm.alignment import align, link_counts, score_links
from feedback_spark.llm.ann import nearest_neighbours
from feedback_spark.llm.bpe import decode, encode
from feedback_spark.llm.exact_topk import exact_topk
from feedback_spark.llm.mixing import MOST_LABELLED, mix
from feedback_spark.llm.packing import best_fit_pack, word_count
from feedback_spark.llm.secret_scan import digest, scan
from feedback_spark.llm.simhash import near_duplicates
from feedback_spark.llm.spelling import spelling_variants
from feedback_spark.llm.token_counts import count_tokens
from feedback_spark.llm.token_shards import training_order
from feedback_spark.llm.toxicity import Model, fit, toxicity

#: op1: share of folds held out, and the score from which a text is called toxic.
TOXIC_FOLDS, TOXIC_HELD_OUT, TOXIC_FROM = 4, 2, 0.3
#: op3: number of folds, and the one held out.
LANG_FOLDS, LANG_HELD_OUT = 5, 0
#: op10: a document over this many tokens is over the limit.
TOKEN_LIMIT = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxic_model(spark: SparkSession, sf_dir: str) -> Model:
    """Learned from the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD_OUT)
    return fit(table(spark, sf_dir, "documents"), labels.select("doc_id", "toxic"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), toxic_model(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "total", "n_hits", "n_words")


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of the mixing: text and domain (language and quality class) of documents in ``labels``.

    The first ``MOST_LABELLED`` labels in hash order are looked up in the
    documents (a broadcast of their ids), so no texts are shuffled.
    """
    quality = table(spark, sf_dir, "labels").where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = quality.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    docs = table(spark, sf_dir, "documents").where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    return docs.join(F.broadcast(picked), "doc_id").select("text", F.concat_ws("/", "lang", F.when(F.col("quality") == 1, "good").otherwise("poor")).alias("domain"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir)).drop("text_hash")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(F.col("doc_id"), LANG_FOLDS) != LANG_HELD_OUT).select("doc_id", "text", "lang"))
    held_out = F.coalesce(fold(F.col("doc_id"), LANG_FOLDS) == LANG_HELD_OUT, F.lit(False))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, most=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), out="found")
    return found.select("doc_id", *[c.alias(k) for k, c in digest(F.col("found")).items()])


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents"), word_count(F.col("text")))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    return training_order(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, END_MARK, SHUFFLE_KEY)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), tokenizer_path())
    told = coded.select(F.struct("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")).alias("about"), "ids")
    return decode(told, tokenizer_path(), keep=("about",)).select("about.*", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    store = materialise(aligned.select("doc_id", "row", "a_ids", "b_ids", "a_lens", "b_lens", sha), "aligned", codec="zstd")
    return score_links(store, link_counts(store), ("doc_id", "groups_sha256"))


#: Every query against every row: the same integers by brute force.
OP5_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM (SELECT query_id, vec_id, max(score) AS score FROM scored GROUP BY query_id, vec_id))
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: op9: the free id after the vocabulary closes a document; key of the training order.
END_MARK, SHUFFLE_KEY = 50256, "epoch-0"

QUERIES: dict = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_mix_sources": (op2_mix_sources, None),
    "op3_language_id": (op3_language_id, None),
    "op4_simhash": (op4_simhash, None),
    "op5_exact_topk": (op5_exact_topk, OP5_SQL),
    "op6_ann": (op6_ann, None),
    "op7_secret_scan": (op7_secret_scan, None),
    "op8_best_fit_packing": (op8_best_fit_packing, None),
    "op9_token_shards": (op9_token_shards, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_spelling_variants": (op11_spelling_variants, None),
    "op12_bpe_round_trip": (op12_bpe_round_trip, None),
    "op13_alignment": (op13_alignment, None),
}
