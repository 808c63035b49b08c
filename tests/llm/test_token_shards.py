import zlib

import numpy as np
import public_tokenizers
import pytest

from feedback_spark.llm.common import new_folder
from feedback_spark.llm.queries import END_MARK, SHUFFLE_KEY, op9_token_shards, tokenizer_path
from feedback_spark.llm.token_shards import LENGTH, SLOTS, encoding, feistel, read_slots, round_keys, training_order, write_shards

SF = "/root/testdata/sf0.001"
RANKS = open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb").read()
ENC = encoding(RANKS, public_tokenizers.PATTERN)


def brute(text, length):
    ids = [*ENC.encode_ordinary(text or ""), END_MARK]
    return [ids[k:k + length] for k in range(0, len(ids), length)]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65_537])
def test_feistel_is_a_permutation(n):
    a, b = (feistel(np.arange(n), n, round_keys(k)) for k in ("a", "b"))
    assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(n))
    assert n < 100 or (a != b).mean() > 0.9 and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.2
    assert feistel(np.array([n - 1]), n, round_keys("a"))[0] == a[-1]


def test_round_trip_and_resume(spark):
    rows = [(1, "hello world"), (2, ""), (3, None), (None, "été ñ"), (4, "word " * 5000), (5, "same"), (5, "same"), (6, "<|endoftext|> x")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, slot int, payload string").repartition(3)
    path = new_folder(spark, "test-shards")
    n = write_shards(docs, RANKS, public_tokenizers.PATTERN, END_MARK, "k", path, length=8, slots=16)
    want = sorted((str(i), k, s) for i, t in rows for k, s in enumerate(brute(t, 8)))
    got = read_slots(spark, path, slots=16).collect()
    assert n == len(want) == len(got) and sorted(r["slot"] for r in got) == list(range(n))
    assert sorted((str(r["doc_id"]), r["seq_no"], np.frombuffer(r["ids"], "<u2")[:r["n_tokens"]].tolist()) for r in got) == want
    assert all(len(r["ids"]) == 16 and set(np.frombuffer(r["ids"], "<u2")[r["n_tokens"]:].tolist()) <= {END_MARK} for r in got)
    by = {r["slot"]: r for r in got}
    part = read_slots(spark, path, 21, 53, slots=16).collect()
    assert [r["slot"] for r in sorted(part, key=lambda r: r["slot"])] == list(range(21, 54)) and all(by[r["slot"]] == r for r in part)
    shards = spark.read.parquet(path).collect()
    assert all(len(s["payload"]) == s["n"] * s["stride"] and s["first_slot"] == s["shard"] * 16 for s in shards)
    assert sum(s["n"] for s in shards) == n and all(s["n"] == 16 for s in shards if s["shard"] < n // 16)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert training_order(docs, RANKS, public_tokenizers.PATTERN, END_MARK, "k").count() == 0


def test_query_agrees_with_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        for k, ids in enumerate(brute(r["text"], LENGTH)):
            raw = np.array(ids + [END_MARK] * (LENGTH - len(ids)), "<u2").tobytes()
            want[r["doc_id"], k] = (len(ids), zlib.crc32(raw))
    got = op9_token_shards(spark, SF).collect()
    assert {(r["doc_id"], r["seq_no"]): (r["n_tokens"], r["crc"]) for r in got} == want and len(got) == len(want)
    assert sorted(r["slot"] for r in got) == list(range(len(want))) and all(r["shard"] == r["slot"] // SLOTS for r in got)
    assert SHUFFLE_KEY
