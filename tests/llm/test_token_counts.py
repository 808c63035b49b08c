import pytest

from feedback_spark.llm.pretokens import read_file, tokenizer_of
from feedback_spark.llm.queries import TOKEN_LIMIT, op10_token_counts, tokenizer_path
from feedback_spark.llm.token_counts import count_tokens, open_table, pack_table

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " ", "Hello it's 12 don't", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z w v", "Ωmega ΑΣ é ́a ﬁ",
         "日本語 テキスト", "the " * 5000, "z" * 30_000, "the the the", "the the the", "emoji 👩‍👩‍👧 ퟿"]


def brute(text):
    t = tokenizer_of(read_file(tokenizer_path()))
    return len((text or "").encode()), len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("table_size", [0, 3, 1000])
def test_edge_texts_agree_with_the_library(spark, table_size):
    df = spark.createDataFrame([(i if i else None, t, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in count_tokens(df, tokenizer_path(), table_size=table_size).collect()}
    assert got == {(i if i else None): brute(t) for i, t in enumerate(TEXTS)}


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0


def test_query_agrees_with_the_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op10_token_counts(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_bytes"], r["n_tokens"]) == brute(docs[r["doc_id"]])
        assert r["over_limit"] == (r["n_tokens"] > TOKEN_LIMIT)


def test_table_round_trip():
    t = {b"a": 1, b"bb": 2, "é".encode(): 3}
    assert open_table(pack_table(t)) == t
    assert open_table(pack_table({})) == {}
