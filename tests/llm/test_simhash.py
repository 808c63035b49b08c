import random
import re
from itertools import combinations

import pytest
import xxhash

from feedback_spark.llm.components import components
from feedback_spark.llm.queries import op4_simhash
from feedback_spark.llm.simhash import keep_one, links, near_duplicates, simhash, units

SF = "/root/testdata/sf0.001"


def brute_print(text, words=4):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, most=4):
    at = {f: f for f in fps}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x
    for a, b in combinations(sorted(at), 2):
        if (a ^ b).bit_count() <= most:
            at[root(b)] = root(a)
    return {f: root(f) for f in at}


def expected(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = brute_components({f for _, f in prints})
    first = {}
    for i, f in prints:
        if i is not None:
            first[root[f]] = min(first.get(root[f], i), i)
    return sorted(((i, f, first.get(root[f])) for i, f in prints), key=str)


TEXTS = ["", None, " \n\t", "One", "one", "a b c", "A  B\tC d", "a b c d e", "É à b ü", "x " * 9, "x " * 900, "\x1c \x85 y z w"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash((text or "").encode(), 4) == brute_print(text)


def test_edges(spark):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(4, "one"), (None, "alone here we are now"), (7, "a b c d e")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    got = near_duplicates(df).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == expected(rows)
    kept = keep_one(df)
    assert kept.columns == df.columns
    members = {(r["doc_id"], r["text_hash"]): r["root"] for r in got}
    assert kept.count() == len(set(members.values()))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0
    assert keep_one(df).count() == 0


def test_query_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in op4_simhash(spark, SF).collect()), key=str)
    assert got == expected(rows)
    assert len({c for *_, c in got}) < len(rows)


@pytest.mark.parametrize("unit_rows", [8, 10_000])
def test_index_on_clusters(spark, unit_rows):
    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(80):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1}
    df = spark.createDataFrame([((x ^ 2**63) - 2**63,) for x in fps], "fp long")
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in components(links(units(df, 4, unit_rows), 4)).collect()}
    want = brute_components(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(300)]
    got = components(spark.createDataFrame(chain + star + [(5000, 5000)], "a long, b long")).collect()
    by = {}
    for r in got:
        by.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, by.values())) == [list(range(301)), list(range(1000, 1301))]
