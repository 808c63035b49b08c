import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from feedback_spark.llm.alignment import EMPTY, Pair, align, as_text, byte_letters, compose, folded, fragment, groups_of, link_counts, links, packed, score_links, unpacked
from feedback_spark.llm.common import materialise
from feedback_spark.llm.pretokens import read_file, tokenizer_of
from feedback_spark.llm.queries import op13_alignment, tokenizer_path

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " ", "  ", "a ", "\n", " \n x", "Hello it's 12 don't", "a<|endoftext|>b <s>", "x\x1cy\x85z w v\r\rq\rr", "tab\tb \t c\n\n d", "Ωmega ﬁ é", "a▁b", "▁",
         "日本語テキスト" * 40, "the " * 300, "z" * 3001, "the cat", "the cat", "emoji 👩‍👩‍👧 ퟿", "ab" * 900 + "!" * 700, "x\x00y　z q", "foo\nbar\nfoo  bar \n\n\nbaz "]


def libraries():
    a = tokenizer_of(read_file(tokenizer_path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def brute(texts):
    """Per text: the groups by whole-text encoding; then all sums by plain loops."""
    a, b = libraries()
    letters = byte_letters()
    spelled_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for t in texts:
        groups = []
        if t:
            sides = [(i, spelled_a[i]) for i in a.encode(" " + t, add_special_tokens=False).ids], [(i, spell_b(i)) for i in b.encode(t)]
            if all(b"".join(x for _, x in s) == (" " + t).encode() for s in sides):
                ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in sides]
                common, lo = sorted(set(ends[0]) & set(ends[1])), 0
                for hi in common:
                    groups.append(tuple([i for (i, _), e in zip(s, at) if lo < e <= hi] for s, at in zip(sides, ends)))
                    lo = hi
        out.append(groups)
    n = Counter(p for groups in out for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    top = {}
    for (x, _), k in n.items():
        top[x] = max(top.get(x, 0), k)
    rows = []
    for groups in out:
        each = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        rows.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(each), sum(n[p] == top[p[0]] for p in each), sum(n[p] for p in each), text))
    return rows


PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.mark.parametrize("range_bytes,most_broadcast", [(65_536, 4_000_000), (7, 0), (100, 4_000_000)])
def test_edge_texts_equal_brute_force(spark, range_bytes, most_broadcast):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("ab \n\tcd.é日'") for _ in range(rng.randrange(60))) for _ in range(150)]
    df = spark.createDataFrame([(i if i else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, groups string, n int").repartition(5)
    store = materialise(align(df, *PATHS, range_bytes=range_bytes, fan_in=2), "t")
    scored = score_links(store, link_counts(store), ("doc_id", "groups"), most_broadcast)
    got = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in scored.collect()}
    expected = {(i if i else None): x for i, x in enumerate(brute(texts))}
    assert len(got) == len(expected)
    for k in expected:
        assert got[k] == expected[k], (k, texts[k or 0])


def test_empty_table(spark):
    store = materialise(align(spark.createDataFrame([], "doc_id long, text string"), *PATHS), "t")
    for most in (0, 10):
        assert score_links(store, link_counts(store), ("doc_id",), most).count() == 0


def test_composition_is_associative_and_equals_the_whole():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(1, 40)
        ends = tuple(sorted(set(rng.sample(range(1, n + 1), rng.randrange(1, n + 1))) | {n}) for _ in (0, 1))
        ids = tuple([rng.randrange(9) for _ in e] for e in ends)
        cuts = sorted({0, n, *(rng.randrange(n + 1) for _ in range(4))})
        parts = [fragment(*(tuple([x for x, e in zip(row, at) if lo < e <= hi] for row, at in zip(rows, ends)) for rows in (ids, ends))) for lo, hi in zip(cuts, cuts[1:])]
        left = EMPTY
        for p in parts:
            left = compose(left, p)
        right = EMPTY
        for p in reversed(parts):
            right = compose(p, right)
        whole = fragment(ids, ends)
        assert groups_of(left) == groups_of(right) == groups_of(folded(parts)) == groups_of(whole)
        assert left == right == folded(parts) == whole
        assert as_text(*groups_of(whole)).count(";") == len(set(ends[0]) & set(ends[1])) - 1


def test_stretches_spell_the_text():
    p = Pair(read_file(PATHS[0]), open(PATHS[1], "rb").read())
    rng = random.Random(1)
    for _ in range(500):
        t = " " + "".join(rng.choice("ab \n\t\r \x1c　") for _ in range(rng.randrange(1, 30)))
        assert "".join(p.stretches(t)) == t


def test_wide_groups_are_paired_by_distinct_ids():
    rng = random.Random(8)
    a, b = [rng.randrange(5) for _ in range(300)], [rng.randrange(70_000) for _ in range(40)]
    d, x, y, n = links([(b"", b"", b"", b""), (packed(a), packed(b), packed([300]), packed([40]))])
    expected = Counter((i, j) for i in a for j in b)
    assert set(d.tolist()) == {1} and dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == expected
    assert unpacked(packed([0, 2 ** 32 - 1])) == [0, 2 ** 32 - 1]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip([r["doc_id"] for r in docs], brute([r["text"] for r in docs])))
    got = op13_alignment(spark, SF).collect()
    assert len(got) == len(expected)
    for r in got:
        *numbers, text = expected[r["doc_id"]]
        assert [r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if text else "")
