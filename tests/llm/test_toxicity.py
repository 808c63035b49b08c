import pytest

from feedback_spark.llm.queries import op1_toxicity
from feedback_spark.llm.toxicity import Folding, Model, curve_of, features, fit, fold_text, matches, toxicity

SF = "/root/testdata/sf0.1"
M = Model(weights={"idiot ": 4.0, "vequ": 3.0, "vequta ": 5.0}, exceptions=["kind idiot"], curve=[-4.0, 1.0, 1.0])


def brute(model, folded):
    """Word by word, without an automaton."""
    words = folded.split()
    got = []
    for i, w in enumerate(words):
        cand = [v for e, v in model.weights.items() if (e.endswith(" ") and w == e[:-1]) or (not e.endswith(" ") and w.startswith(e))]
        void = any(f"{a} {b}" in model.exceptions for a, b in ((words[i - 1] if i else "", w), (w, words[i + 1] if i + 1 < len(words) else "")))
        if cand and not void:
            got.append(max(cand))
    return sum(got), len(got)


@pytest.mark.parametrize("raw", ["IDIOT", "1d10t", "іdіоt", "ｉｄｉｏｔ", "ídïöt", "idi​ot", "𝐢𝐝𝐢𝐨𝐭"])
def test_folding_undoes_disguises(raw):
    assert fold_text(raw, Folding()) == fold_text("idiot", Folding()) == "idiot"


def test_ordinary_letters_keep_their_accent():
    assert fold_text("Ré-Eux ïd", Folding("é")) == "ré eux id"
    assert fold_text(None, Folding()) == fold_text(" !\n", Folding()) == ""


@pytest.mark.parametrize("text", ["", "idiot", "kind idiot", "idiot kind idiot idiot", "idiots", "vequ vequta vequtas x vequta", "a idiot vequx", "idiot " * 3000])
def test_matches_agree_with_brute_force(text):
    assert matches(M.automaton(), text.strip()) == pytest.approx(brute(M, text))


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "idiot idiot"), (4, "kind idiot"), (5, "x " * 20_000 + "idiot"), (5, "idiot idiot"), (5, "idiot idiot")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, score string")
    got = toxicity(df, M).collect()
    assert len(got) == len(rows)
    by = [(r["doc_id"], r["n_hits"], round(r["score"], 6)) for r in got]
    low = by[0][2]
    assert by[1] == (2, 0, low) and by[3] == (4, 0, low)
    assert by[2][1:] == by[5][1:] == by[6][1:] and by[2][2] > by[4][2] > low
    assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity(df.limit(0), M).count() == 0


def test_fit_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit(docs, none)
    assert not model.weights and all(r["score"] < 0.01 for r in toxicity(docs, model).collect())
    assert not fit(docs, spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")).weights
    assert fit(docs, spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, toxic int")).weights == {}


def test_curve_rises_with_weight():
    c = curve_of([(1, 9.0, 50)] * 20 + [(0, 0.0, 50)] * 80 + [(0, 2.0, 500)] * 5, {0: 1.0, 1: 1.0})
    z = [sum(a * b for a, b in zip(c, features(t, 50), strict=True)) for t in (0.0, 3.0, 9.0)]
    assert z == sorted(z) and z[2] > 0 > z[0]


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op1_toxicity(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    pos = [g["score"] for g, y in held if y == 1]
    neg = [g["score"] for g, y in held if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.95
    hits = sum(g["predicted"] for g, y in held if y == 1)
    assert hits >= 0.9 * len(pos) and sum(g["predicted"] for g, y in held if y == 0) <= 0.02 * len(neg)
