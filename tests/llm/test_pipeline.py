import os
import sys

import pytest

import corpus_pipeline as P
from feedback_spark.llm.common import materialise
from feedback_spark.llm.queries import TOXIC_FROM, toxic_model
from feedback_spark.llm.secret_scan import thresholds, with_spans
from feedback_spark.llm.toxicity import Folding, fold_text, scored

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "mixing", "best_fit_packing"] and P.ORACLE_SQL is None


def test_columns(stages):
    assert all(sorted(s.columns) == sorted(stages[0].columns) for s in stages[:-1])


def test_toxic_documents_go(spark, stages):
    m = toxic_model(spark, SF)
    a, f = m.automaton(), Folding(m.alphabet)
    want = sorted(r["doc_id"] for r in stages[0].collect() if scored(m, a, fold_text(r["text"], f))[3] < TOXIC_FROM)
    assert sorted(r["doc_id"] for r in stages[1].collect()) == want and len(want) < stages[0].count()


def test_one_of_each_group_stays(stages):
    from test_simhash import expected

    before = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = sorted({c for _, _, c in expected(before)})
    assert sorted(r["doc_id"] for r in stages[2].collect()) == want and len(want) < len(before)


def test_secrets_are_hidden(stages):
    from test_secret_scan import brute

    before, after = ({r["doc_id"]: r for r in s.collect()} for s in stages[2:4])
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i]["text"] != after[i]["text"]]
    assert all(not brute(after[i]["text"]) for i in after)
    found = {r["doc_id"] for r in with_spans(stages[2], thresholds(stages[2])).collect() if r["spans"]}
    assert set(changed) == found
    assert all(after[i]["n_chars"] == len(after[i]["text"]) for i in changed)


def test_mixing_keeps_every_document(stages):
    before, after = stages[3].collect(), stages[4].collect()
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after} and len(after) > len(before)
    n = {}
    for r in after:
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + 1
    assert max(n.values()) <= P.MOST_RATE + 1


def test_packing_holds_every_word(stages):
    words = sum(len((r["text"] or "").split()) for r in stages[4].collect())
    assert words == sum(r["n_tokens"] for r in stages[5].collect())


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 20_000, "en", "s", 5), (3, "a b c", None, None, 5), (3, "a b c", None, None, 5), (4, "token=abcdefgh12", "en", "s", 16)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, __extra string, rate double")
    for given in (docs, docs.limit(0)):
        at = given
        for name, stage in P.STAGES:
            at = materialise(stage(spark, at, SF), f"odd-{name}")
        assert {r["doc_id"] for r in at.collect()} == ({1, 2, 3, 4} if given is docs else set())
