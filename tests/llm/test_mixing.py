import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedback_spark.llm.mixing import expected, mix, posteriors, fit_classifier, rate_column, resample, solve
from feedback_spark.llm.queries import op2_mix_sources

SF = "/root/testdata/sf0.01"


def frame(spark, p, n, copies=None):
    return spark.createDataFrame([(i, float(len(p)), int(c), int(k), [float(x) for x in row]) for i, (row, k, c) in enumerate(zip(p, n, copies or [1] * len(p), strict=True))],
                                 "doc_id long, text_hash double, copies long, n_tokens long, p array<double>")


def brute(p, n, goal, lower, upper, passes):
    """The same projected gradient with numpy."""
    p, n = np.array(p), np.array(n, float)
    natural = (p * n[:, None]).sum(0)
    r = np.ones(len(n))
    for _ in range(passes):
        gap = ((p * (n * r)[:, None]).sum(0) - goal) / natural
        r = np.clip(r - p @ gap, lower, upper)
    return r, (p * (n * r)[:, None]).sum(0)


@pytest.mark.parametrize("lower,upper", [(0.0, math.inf), (0.5, 2.0)])
def test_rates_agree_with_numpy(spark, lower, upper):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3] * 4, 200)
    n = rng.integers(1, 500, 200)
    table = frame(spark, p, n)
    steps, report = solve(table, list("abcd"), {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, lower=lower, upper=upper)
    goal = np.array([g for _, g in report.values()])
    assert goal.sum() == pytest.approx(n.sum())
    r, totals = brute(p, n, goal, lower, upper, len(steps))
    got = [x[0] for x in table.orderBy("doc_id").select(rate_column(steps, lower, upper)).collect()]
    assert got == pytest.approx(r.tolist(), rel=1e-9) and min(got) >= lower and max(got) <= upper
    assert [t for t, _ in report.values()] == pytest.approx(totals.tolist(), rel=1e-9)
    if lower == 0:
        assert np.abs(totals - goal).max() < 0.01 * n.sum()


def test_hard_membership_is_solved_at_once(spark):
    p = [[1, 0]] * 3 + [[0, 1]]
    table = frame(spark, p, [10, 10, 10, 30])
    steps, report = solve(table, ["a", "b"], {"a": 1, "b": 3})
    assert [round(x[0], 6) for x in table.orderBy("doc_id").select(rate_column(steps, 0.0, math.inf)).collect()] == [0.5] * 3 + [1.5]
    assert report["a"] == pytest.approx((15.0, 15.0))


def test_copies_count_like_rows(spark):
    a = expected(frame(spark, [[0.25, 0.75]], [8], [3]), F.lit(1.0), 2)
    assert a == expected(frame(spark, [[0.25, 0.75]] * 3, [8] * 3), F.lit(1.0), 2) == [6.0, 18.0]


def test_edges(spark):
    labelled = spark.createDataFrame([("le chat noir", "fr"), ("the black cat", "en"), (None, "en"), ("x", None)], "text string, domain string")
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (2, ""), (3, "chat " * 20_000), (4, "123 !")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, rate string")
    got = mix(docs, labelled).collect()
    assert len(got) == len(rows)
    assert all(r["rate"] >= 0 and sum(r["p"]) == pytest.approx(1) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["domain"] == "en" and by[3]["domain"] == "fr" and by[3]["n_tokens"] == 20_000 and by[1]["n_tokens"] == 2
    assert by[None]["n_tokens"] == by[2]["n_tokens"] == 0 and by[None]["p"] == by[2]["p"] == by[4]["p"]
    assert mix(docs.limit(0), labelled).count() == 0
    none = mix(docs, labelled.limit(0)).collect()
    assert len(none) == len(rows) and all(r["rate"] == 1.0 and r["domain"] == "all" for r in none)


def test_many_domains_share_other(spark):
    labelled = spark.createDataFrame([(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", f"d{i:03}") for i in range(90)], "text string, domain string")
    model = fit_classifier(labelled)
    assert len(model.domains) == 64 and "other" in model.domains
    assert posteriors(spark.createDataFrame([(1, "waa")], "doc_id long, text string"), model).count() == 1


def test_resample_repeats_rows(spark):
    docs = spark.createDataFrame([(i, f"t{i}", 5) for i in range(2000)] + [(None, None, 1)], "doc_id long, text string, n_chars long")
    rates = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.when(F.col("doc_id") < 1000, 2.0).otherwise(F.when(F.col("doc_id").isNull(), 1.0).otherwise(0.25)).alias("rate"))
    out = resample(docs, rates)
    n = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert out.columns == docs.columns and all(n[i] == 2 for i in range(1000)) and n[None] == 1
    assert 180 < sum(n.get(i, 0) for i in range(1000, 2000)) < 320


def test_query_reaches_the_targets(spark):
    rows = op2_mix_sources(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(rows) == len(docs)
    lang = {r["doc_id"]: r["lang"] for r in docs}
    assert sum(r["domain"].startswith(lang[r["doc_id"]] + "/") for r in rows) > 0.95 * len(rows)
    p = np.array([r["p"] for r in rows])
    n = np.array([r["n_tokens"] for r in rows], float)
    natural = (p * n[:, None]).sum(0)
    goal = natural ** 0.5 / (natural ** 0.5).sum() * n.sum()
    mixed = (p * (n * np.array([r["rate"] for r in rows]))[:, None]).sum(0)
    assert np.abs(mixed - goal).sum() < 0.05 * n.sum() < np.abs(natural - goal).sum()
