"""Theme tags, request / churn sentences and competitor counts against Python ``re``
(the original engine's semantics) on the sf0.001 scored layer."""

import re
from collections import Counter

from feedback_spark import fixed_values as FV
from feedback_spark.operators import metrics as M
from feedback_spark.operators import signals as G
from feedback_spark.plans.base import scored_layer

SF = "/root/testdata/sf0.001"


def _rows(spark):
    return scored_layer(spark, SF).select("product", "product_type", "review_id", "review_text", "sentiment", "themes").collect()


def test_theme_tags(spark):
    for r in _rows(spark):
        want = [t for t, p in FV.THEME_PATTERNS[r.product_type] if re.search(p, r.review_text.lower(), re.IGNORECASE)]
        assert list(r.themes) == want, (r.review_id, r.themes, want)


def _first_counts(items):
    c, first = Counter(), {}
    for key, s in items:
        c[s] += 1
        first.setdefault(s, key)
    return sorted(c.items(), key=lambda kv: (-kv[1], first[kv[0]]))


def test_feature_requests(spark):
    """Rows of FIXTURES.md section 6, with the answer worked out by hand."""
    ask = "It would be nice if it had dark mode"
    rows = [
        ("P", 1, "Neutral", f"Fine so far. {ask}."), ("P", 2, "Negative", f"{ask}! Thanks"), ("P", 3, "Positive", f"{ask}."),
        ("P", 4, "Neutral", "would be nice if so"), ("P", 5, "Neutral", f"It would be nice if it had {'very ' * 40}long lists"),
        ("P", 6, "Negative", "Please add support for more brokers in the next version"), ("Q", 7, "Neutral", "Nothing is asked for in this text"),
    ]
    df = spark.createDataFrame(rows, "product string, review_id long, sentiment string, review_text string")
    got = [(r.product, r.rank, r.snippet, r.n, r.first_review_id) for r in G.feature_requests(df).orderBy("rank").collect()]
    assert got == [("P", 1, ask, 2, 1), ("P", 2, rows[5][3], 1, 6)]


def test_churn_sentences(spark):
    rows = sorted(_rows(spark), key=lambda r: r.review_id)
    pat = re.compile(FV.CHURN_PATTERN, re.I)
    got = {}
    for r in G.churn_sentences(scored_layer(spark, SF), n=4).collect():
        got.setdefault(r.product, []).append((r.snippet, r.n))
    for prod in {r.product for r in rows}:
        items = []
        for r in rows:
            if r.product != prod or not pat.search(r.review_text):
                continue
            for pos, sent in enumerate(re.split(r"[.!?\n]", r.review_text)):
                if pat.search(sent) and len(sent.strip()) > 15:
                    items.append(((r.review_id, pos), sent.strip()[:120]))
        assert [tuple(x) for x in got.get(prod, [])] == _first_counts(items)[:4], prod


def test_competitor_counts(spark):
    rows = _rows(spark)
    got = {(r.product, r.competitor): r.mentions for r in G.competitor_mentions(scored_layer(spark, SF)).collect()}
    want = Counter()
    for r in rows:
        for name, p in FV.COMPETITOR_PATTERNS[r.product_type]:
            if name.lower() != r.product.lower() and re.search(p, r.review_text, re.I):
                want[(r.product, name)] += 1
    assert got == dict(want)
    assert sum(x.mentions for x in M.theme_mentions(scored_layer(spark, SF)).collect()) == sum(len(r.themes) for r in rows)
