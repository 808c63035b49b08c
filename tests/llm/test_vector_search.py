import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedback_spark.llm import ann, exact_topk as E, vectors
from feedback_spark.llm.queries import OP5_SQL, op5_exact_topk, op6_ann
from feedback_spark.plans.compare import duck

SF = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")
ODD = [(1000, None), (1001, [1.0, None]), (1002, [NAN, 1.0]), (1003, [INF, 1.0]), (1004, []), (None, [0.5, 0.5])]


def data(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((n, d)).round(2))]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")


def brute(rows, step, k, score, largest):
    best = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            best.setdefault(i, []).append(v)
    out = set()
    for q in best:
        if q % step == 0:
            got = {}
            for i, vs in best.items():
                for v in vs:
                    if i != q and len(v) == len(min(best[q])):
                        s = score(min(best[q]), v)
                        got[i] = s if i not in got else (max if largest else min)(got[i], s)
            order = sorted(got, key=lambda i: (-got[i] if largest else got[i], i))[:k]
            out |= {(q, r + 1, i, got[i]) for r, i in enumerate(order)}
    return out


def inner(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("n,d", [(300, 24), (40, 1), (3, 5), (1, 4)])
def test_exact_agrees_with_brute_force(spark, n, d):
    rows = data(n, d)
    got = {tuple(r) for r in E.exact_topk(frame(spark, rows), F.col("vec_id") % 10 == 0, 5).collect()}
    assert got == brute(rows, 10, 5, inner, True)


def test_exact_edges(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES_A_PASS", 7)
    same = [(i, [0.25] * 8) for i in range(200, 500)]
    rows = data(100, 8) + data(30, 8) + same + [(700, [0.1, 0.2]), (701, [0.3, 0.1]), (710, [1e200, -1e200])] + ODD
    got = [tuple(r) for r in E.exact_topk(frame(spark, rows), F.col("vec_id") % 10 == 0, 5).collect()]
    want = {(q, r, i, max(-2 ** 63, min(2 ** 63 - 1024, s))) for q, r, i, s in brute(rows, 10, 5, inner, True)}
    assert len(got) == len(set(got)) and set(got) == want
    assert E.exact_topk(frame(spark, []), F.col("vec_id") % 10 == 0, 5).count() == 0
    assert E.exact_topk(frame(spark, [(1, [1.0])]), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-200, 200, (50, 30)).astype(float), rng.integers(-200, 200, (6, 30)).astype(float)
    last = None
    for s in (1, 4, 8, 16):
        bound = E.statistics(q, s) @ E.statistics(x, s).T
        assert (bound >= q @ x.T - 1e-6).all()
        assert last is None or bound.mean() <= last
        last = bound.mean()


def test_exact_query_agrees_with_sql(spark):
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in op5_exact_topk(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(duck("/root/testdata/sf0.001").execute(OP5_SQL).fetchall())


def test_ann_with_all_lists_is_nearly_exact(spark):
    rows = data(600, 32, 3) + [(i, [0.25] * 32) for i in range(900, 930)] + ODD + [(2000, [0.0] * 32), (2010, [1.0, 2.0])]
    got = ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 100 == 0, 10, probed=1.0).collect()
    part = [(i, v) for i, v in rows if i is not None and v and len(v) == 32 and any(v)]
    want = brute(part, 100, 10, lambda a, b: math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))), False)
    by, true = {}, {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, r, i, s in want:
        true.setdefault(q, []).append((r, i, s))
    assert by.keys() == true.keys()
    vec = dict(part)
    for q, found in by.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, len(true[q]) + 1))
        assert all(s == pytest.approx(math.dist(vec[q], vec[i]), rel=1e-12) for _, i, s in found)
    assert sum(len({i for _, i, _ in by[q]} & {i for _, i, _ in true[q]}) for q in by) >= 0.95 * len(want)
    assert [(r, i) for r, i, _ in sorted(by[900])] == [(r, i) for r, i, _ in sorted(true[900])]  # ties: smaller ids first


def test_ann_edges(spark):
    q = F.col("vec_id") % 100 == 0
    assert ann.nearest_neighbours(frame(spark, []), q, 10).count() == 0
    assert ann.nearest_neighbours(frame(spark, ODD + [(100, [0.0, 0.0])]), q, 10).count() == 0
    few = ann.nearest_neighbours(frame(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]), q, 10).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in few) == [(1, 2), (2, 1)]


def test_large_lists_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_A_DEAL", 50)
    rows = data(300, 8, 5) + [(i, [0.25] * 8) for i in range(1000, 1300)]
    index = ann.build_index(frame(spark, rows))
    assert index.table.agg(F.sum("n")).first()[0] == index.rows == 600


def test_copies_over_several_blocks_keep_the_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 32)
    ids = np.random.default_rng(6).permutation(np.arange(1000, 1400)).tolist()
    copies = [(i, v) for v in ([float(x) for x in np.random.default_rng(8).standard_normal(64)],) for i in ids]
    got = ann.nearest_neighbours(frame(spark, data(200, 64, 7) + copies), F.col("vec_id") == 1000, 10, probed=1.0).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(k, 1000 + k, 0.0) for k in range(1, 11)]


def test_every_vector_of_a_query_id_is_searched(spark, tmp_path):
    rows = data(120, 8, 4) + [(i, [-3 * x for x in v]) for i, v in data(120, 8, 5)] + [(100, [5.0, 1.0]), (7, [0.5, 2.0])]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in op5_exact_topk(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert got == sorted(con.execute(OP5_SQL).fetchall())
    twins = [(0, [1.0, 1.0]), (0, [9.0, 9.0]), (1, [1.0, 1.0]), (2, [9.0, 9.0]), (3, [5.0, 5.5])]
    near = ann.nearest_neighbours(frame(spark, twins), F.col("vec_id") == 0, 2).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in near) == [(1, 1, 0.0), (2, 2, 0.0)]


def test_ann_searches_every_dimension(spark):
    rows = data(300, 16, 1) + [(i + 1000, v) for i, v in data(120, 6, 2)] + [(i + 2000, v) for i, v in data(3, 2, 3)]
    got = {tuple(r)[:3] for r in ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 100 == 0, 10, probed=1.0).collect()}
    want = {x[:3] for x in brute(rows, 100, 10, math.dist, False)}
    assert {q for q, _, _ in got} == {0, 100, 200, 1000, 1100, 2000} and len(got) == len(want) == 52
    assert {x for x in got if x[0] == 2000} == {x for x in want if x[0] == 2000} and len({x[::2] for x in got} & {x[::2] for x in want}) >= 0.9 * len(want)


def test_ann_recall(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got = {}
    for r in op6_ann(spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = n = 0
    for j in np.flatnonzero(ids % 100 == 0):
        dist = ((x - x[j]) ** 2).sum(1)
        dist[j] = np.inf
        true = set(ids[np.lexsort((ids, dist))[:10]].tolist())
        hits, n = hits + len(true & got[ids[j]]), n + len(true)
    assert hits / n >= 0.9
