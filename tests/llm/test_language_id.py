import random

import numpy as np
import pytest

from feedback_spark.llm import language_id as L
from feedback_spark.llm.queries import op3_language_id

SF = "/root/testdata/sf0.01"


def brute_phrases(text, sample):
    """Greedy parse by substring search; a symbol that the sample lacks is a phrase of its own."""
    n, at = 0, 0
    while at < len(text):
        k = at + 1
        while k <= len(text) and text[at:k] in sample:
            k += 1
        at = max(at + 1, k - 1)
        n += 1
    return n


def model_of(**texts):
    letters = sorted({c for t in texts.values() for c in t if c != " "})
    place = {c: i + 2 for i, c in enumerate(letters)}
    import base64
    import zlib
    return {"langs": sorted(texts), "letters": "".join(letters),
            "sequences": [base64.b64encode(zlib.compress(bytes(L.GAP if c == " " else place[c] for c in texts[k]))).decode() for k in sorted(texts)]}


@pytest.mark.parametrize("seed", range(4))
def test_parse_agrees_with_substring_search(seed, monkeypatch):
    rng = random.Random(seed)
    a, b = ("".join(rng.choices("ab c", weights=w, k=120)).replace("  ", " ") for w in ([5, 3, 1, 1], [1, 2, 5, 2]))
    parser = L.Parser(model_of(x=a, y=b))
    texts = [" ".join("".join(rng.choices("abcd ", k=n)).split()) for n in (1, 7, 60, 300)] + [""]
    monkeypatch.setattr(L, "STRETCH", 50)
    got = parser.phrases([parser.symbols(t) for t in texts])
    for t, row in zip(texts, got.tolist(), strict=True):
        cuts = [t[i:i + 50] for i in range(0, len(t), 50)]
        assert row == [sum(brute_phrases(c, s) for c in cuts) for s in (a, b)]


def test_hashed_transitions_parse_like_the_dense_table(monkeypatch):
    rng = random.Random(9)
    model = model_of(x="".join(rng.choices("ab c", k=300)), y="".join(rng.choices("bcd ", k=300)), z="ab")
    texts = [" ".join("".join(rng.choices("abcdz ", k=n)).split()) for n in (1, 9, 200, 3000)] + [""]
    dense = L.Parser(model)
    monkeypatch.setattr(L, "CELLS", 0)
    sparse = L.Parser(model)
    assert sparse.table is None and dense.sparse is None
    assert (sparse.phrases([sparse.symbols(t) for t in texts]) == dense.phrases([dense.symbols(t) for t in texts])).all()


def test_rare_letters_of_large_alphabets_tell_languages_apart(spark):
    rng = random.Random(12)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)]
    rng.shuffle(letters)
    sets = {f"l{i}": letters[100 * i:100 * i + 100] for i in range(20)}
    text = lambda s, n: "".join(rng.choices(s, k=n))
    rows = [(i * 100 + j, text(s, 1500), lang) for i, (lang, s) in enumerate(sets.items()) for j in range(10)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model["letters"]) == 2000
    parser = L.Parser(model)
    assert (parser.bits > np.log2(14_000)).all()  # ten texts of 1,500 letters, not cut
    langs, _ = parser.judge([text(s, 200) for s in sets.values()])
    assert langs == list(sets)


def test_symbols_close_gaps():
    parser = L.Parser(model_of(x="ab"))
    assert parser.symbols("  A, b!?12 zé ").tolist() == [2, 0, 3, 0, 1, 1]
    assert parser.symbols("").tolist() == parser.symbols("12 !").tolist() == []


def test_edges(spark):
    train = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "fr"), ("x", None), ("", "en"), ("le chat noir", "fr")])], "doc_id long, text string, lang string")
    model = L.fit(train)
    assert model["langs"] == ["en", "fr"]
    rows = [(1, "The dog"), (2, "le chien"), (None, None), (3, ""), (4, "12 !?"), (5, "chat " * 30_000), (5, "chat"), (5, "chat"), (6, "日本")]
    docs = spark.createDataFrame([(i, t, "en", "clash") for i, t in rows], "doc_id long, text string, lang string, score string")
    got = L.identify(docs, model).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in got[:6]] == [(1, "en"), (2, "fr"), (None, "und"), (3, "und"), (4, "und"), (5, "fr")]
    assert len(got) == len(rows) and got[8]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got)
    assert got[6] == got[7]
    assert L.identify(docs.limit(0), model).count() == 0
    none = L.fit(train.limit(0))
    assert {r["lang_pred"] for r in L.identify(docs, none).collect()} == {"und"}


def test_sample_is_bounded(spark):
    train = spark.createDataFrame([(i, f"word{i} " * 500, "en") for i in range(300)], "doc_id long, text string, lang string")
    model = L.fit(train, docs_a_lang=5, chars_a_doc=100, symbols_a_lang=200)
    assert len(L.Parser(model).table) <= 400 * (len(model["letters"]) + 2)


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = op3_language_id(spark, SF).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
