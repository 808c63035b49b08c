"""FIXTURES.md §5 response-file cases (golden, small)."""

import json

from pyspark.sql import functions as F

from feedback_spark.operators import enrich as K


def test_salvage_cases():
    s = K._salvage
    assert len(s('[{"idx":1},{"idx":2}]')) == 2
    assert len(s('[{"idx":1}')) == 1                          # no closing bracket
    assert len(s('[{"idx":1},{"idx":2,"the')) == 1            # cut inside an object
    assert len(s('[{"idx":1}] done')) == 1                    # trailing prose
    assert len(s('[{"idx":1,"k":"a } b"},{"id')) == 1         # brace inside a string
    assert json.loads(s('[{"idx":1,"k":"a } b"},{"id')[0])["k"] == "a } b"
    assert s("sorry") == []                                    # no array


CASES = [
    ("a_response_b01.json", '[{"idx":1,"sentiment":"Positive"},{"idx":2,"sentiment":"Negative"}]', 2),
    ("a_response_b02.json", '```json\n[{"idx":3},{"idx":4}]\n```', 2),
    ("a_response_b03.json", '{"results":[{"idx":5},{"idx":6}]}', 2),
    ("a_response_b04.json", '[{"idx":7}', 1),
    ("a_response_b05.json", '[{"idx":8},{"idx":9,"the', 1),
    ("a_response_b06.json", '[{"idx":10}] done', 1),
    ("a_response_b07.json", '[{"idx":11,"k":"a } b"},{"id', 1),
    ("a_response_b08.json", "sorry", 0),
    ("a_response_b09.json", '[{"idx":"2","sentiment":"Neutral"},{"sentiment":"Mixed"}]', 2),
]


def test_parse_responses(spark):
    raw = spark.createDataFrame([(f, b) for f, b, _ in CASES], "file string, body string")
    p = K.parse_responses(raw, size=2)
    counts = {r.file: r.n for r in p.groupBy("file").count().withColumnRenamed("count", "n").collect()}
    for f, _, n in CASES:
        assert counts.get(f, 0) == n, f
    # idx as text -> 2; missing idx -> position based: (9 - 1) * 2 + 1 + 1 = 18
    b9 = {r.i: r.idx for r in p.filter(F.col("file") == "a_response_b09.json").collect()}
    assert b9 == {0: 2, 1: 18}


def test_range_and_last_write_wins(spark):
    raw = spark.createDataFrame([
        ("x/a_response_b01.json", '[{"idx":1,"sentiment":"Negative"},{"idx":0},{"idx":99}]'),
        ("y/a_response_b01.json", '[{"idx":1,"sentiment":"Positive"}]'),
    ], "file string, body string")
    p = K.parse_responses(raw, size=150)
    totals = spark.createDataFrame([("a", 10)], "slug string, total long")
    checked = K.split_out_of_range(p, totals)
    assert checked.filter("NOT in_range").count() == 2
    win = K.last_write_wins(checked.filter("in_range")).collect()
    assert [(w.idx, w.sentiment, w.file) for w in win] == [(1, "Positive", "y/a_response_b01.json")]
