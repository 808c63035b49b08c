import hashlib
import random
import struct

import pytest

from feedback_spark.llm.bpe import Codec, decode, encode, join, packed, tree, unpacked
from feedback_spark.llm.pretokens import read_file, tokenizer_of
from feedback_spark.llm.queries import op12_bpe_round_trip, tokenizer_path

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " ", "Hello it's 12 don't", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z w v", "Ωmega ΑΣ é ́a ﬁ", "日本語 テキスト",
         "the " * 5000, "z" * 30_001, "the the the", "the the the", "emoji 👩‍👩‍👧 ퟿", "ab" * 9000 + "<|endoftext|>" + "ab" * 9001 + "'s" + "!" * 7000,
         "<|ENDOFTEXT|>" + "Straße" * 3000 + "1234567890" * 700, "x " + "é" * 5000 + " y", "日本語テキスト" * 2000, "Eu9" * 3000 + "-" * 4097]


@pytest.fixture(scope="module")
def library():
    return tokenizer_of(read_file(tokenizer_path()))


@pytest.fixture(scope="module")
def codec():
    return Codec(read_file(tokenizer_path()))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("long_run,leaf", [(4096, 2048), (1, 3)])
def test_edge_texts_agree_with_the_library(spark, library, long_run, leaf):
    df = spark.createDataFrame([(i if i else None, t, "k", "r") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, row string")
    coded = encode(df, tokenizer_path(), long_run=long_run, leaf=leaf)
    assert coded.columns == ["doc_id", "ids"]
    got = {r["doc_id"]: unpacked(bytes(r["ids"])) for r in coded.collect()}
    assert got == {(i if i else None): ids_of(library, t) for i, t in enumerate(TEXTS)}
    texts = {r["doc_id"]: r["text"] for r in decode(coded, tokenizer_path()).collect()}
    assert texts == {k: library.decode(v, skip_special_tokens=False) for k, v in got.items()}


def test_helper_names_as_kept_columns(spark, library):
    df = spark.createDataFrame([(1, "c", "z" * 9000), (2, "d", "short")], "row long, c1 string, text string")
    got = {(r["row"], r["c1"]): unpacked(bytes(r["ids"])) for r in encode(df, tokenizer_path(), keep=("row", "c1")).collect()}
    assert got == {(1, "c"): ids_of(library, "z" * 9000), (2, "d"): ids_of(library, "short")}


def test_empty_table(spark):
    coded = encode(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path())
    assert coded.count() == 0 and decode(coded, tokenizer_path()).count() == 0


def test_null_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(packed([320, 4_000_000, 320])))], "doc_id long, ids binary")
    t = tokenizer_of(read_file(tokenizer_path()))
    assert {r["doc_id"]: r["text"] for r in decode(df, tokenizer_path()).collect()} == {1: "", 2: t.decode([320, 320], skip_special_tokens=False)}


def test_tree_equals_the_whole_word(codec):
    rng = random.Random(4)
    for letters in ("z", "ab", "the", "abcdefghijklmnopqrstuvwxyz", "etaoinshr", "ha"):
        for n in (1, 2, 7, 50, 333, 2000):
            word = "".join(rng.choice(letters) for _ in range(n))
            whole = codec.piece_ids(word, True)
            for leaf in (1, 2, 5, 64):
                cuts = range(0, n, leaf)
                leaves = [codec.piece_ids(word[k:k + leaf], k + leaf >= n) for k in cuts]
                assert tree(leaves, codec.again) == whole, (word, leaf)


def test_window_grows_until_both_sides_agree(codec):
    # the pieces of a run of one letter depend on how far its start is away: agreement comes late
    word = "z" * 997
    left, right = codec.piece_ids(word[:500], False), codec.piece_ids(word[500:], True)
    assert join(left, right, codec.again, True, window=1) == codec.piece_ids(word, True)


def test_byte_level_vocabulary_without_word_ends(spark):
    t = tokenizer_of(read_file(tokenizer_path("byte_bpe_50k.json")))
    words = ["q" * 9000, "héllo" * 2000, "x"]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id int, text string")
    coded = encode(df, tokenizer_path("byte_bpe_50k.json"), leaf=100)
    assert {r["doc_id"]: unpacked(bytes(r["ids"])) for r in coded.collect()} == {i: t.encode(w).ids for i, w in enumerate(words)}
    assert {r["doc_id"]: r["text"] for r in decode(coded, tokenizer_path("byte_bpe_50k.json")).collect()} == dict(enumerate(words))


def test_query_agrees_with_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op12_bpe_round_trip(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = ids_of(library, docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
