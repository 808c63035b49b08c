"""A / B sources on golden fixtures."""

import os
import tempfile

from feedback_spark.sources import files as A
from feedback_spark.sources.html import parse_page

CSV = '''platform,date,author,rating,review_text,source_url
reddit,2026-03-06,a,,"first line
second line, with comma",https://x/1
reddit,2026-03-07,b,x,"she said ""great"" twice",https://x/2
reddit,2 weeks ago,c,4,plain text review here,https://x/3
'''


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_read_reviews_multiline_and_quotes(spark):
    tmp = tempfile.mkdtemp()
    p = _write(tmp, "reviews.csv", CSV)
    rows = A.read_reviews(spark, p).orderBy("author").collect()
    assert len(rows) == 3
    assert rows[0].review_text == "first line\nsecond line, with comma"
    assert rows[1].review_text == 'she said "great" twice' and rows[1].rating is None
    assert rows[2].rating == 4.0


def test_resolve_tier_and_catalogue(spark):
    tmp = tempfile.mkdtemp()
    p = _write(tmp, "clean.csv", CSV)
    df = A.resolve_tier(spark, [os.path.join(tmp, "missing.csv"), p])
    assert df.count() == 3
    assert A.resolve_tier(spark, [os.path.join(tmp, "none.csv")]).count() == 0
    cat = A.catalogue(spark, tmp).collect()
    assert [(c.file, c.records) for c in cat] == [("clean.csv", 3)]    # records, not physical lines


def test_read_responses(spark):
    tmp = tempfile.mkdtemp()
    _write(tmp, "a_response_b01.json", "[1,\n2]")
    _write(tmp, "a_response_b12.json", "[3]")
    rows = A.read_responses(spark, os.path.join(tmp, "*_response_b*.json")).orderBy("batch_no").collect()
    assert [r.batch_no for r in rows] == [1, 12] and rows[0].body == "[1,\n2]"


TP = """<html><body>
<article data-service-review-card-paper="true"><h2 data-service-review-title-typography="true"> Good </h2>
<div data-service-review-rating="4"></div><p data-service-review-text-typography="true">Fast &amp; easy</p>
<time datetime="2026-01-02T10:00:00.000Z"></time><aside aria-label="Info for Ann"></aside></article>
<article data-service-review-card-paper="true"><p data-service-review-text-typography="true">No rating card</p></article>
<article data-service-review-card-paper="true"><div data-service-review-rating="x"></div><h2 data-service-review-title-typography="true">T</h2></article>
<article data-service-review-card-paper="true"></article>
</body></html>"""

MAPS = """<div data-review-id="1"><div class="d4r55">Bo</div><span aria-label="5 stars"></span>
<span class="rsqaWe">2 weeks ago</span><span class="wiI7pd">Driver was on time</span></div>
<div class="jJc9Ad"><span class="wiI7pd">short</span></div>"""


def test_trustpilot_cards():
    cards = parse_page(TP, "trustpilot")
    assert len(cards) == 4
    assert cards[0] == {"title": "Good", "rating": "4", "text": "Fast & easy", "date": "2026-01-02", "author": "Ann"}
    assert "rating" not in cards[1] and cards[2]["rating"] == "x"


def test_html_jobs(spark):
    pages = spark.createDataFrame([(1, "https://t/1", TP), (2, "https://m/2", MAPS), (3, "https://t/3", "<html></html>")],
                                  "page_id long, url string, html string")
    from feedback_spark.sources.payloads import from_maps_html, from_trustpilot_html

    tp = from_trustpilot_html(pages).orderBy("page_id", "card").collect()
    assert [(r.review_text, r.rating) for r in tp] == [("Good Fast & easy", 4.0), ("No rating card", None), ("T", None)]
    mp = from_maps_html(pages).collect()
    assert [(r.review_text, r.rating, r.author, r.date) for r in mp] == [("Driver was on time", 5.0, "Bo", "2 weeks ago")]


VOID = """<main><article data-service-review-card-paper="1"><img src="a.png"><p data-service-review-text-typography="1">one<br>two<br></p>
<p>unclosed<time datetime="2026-03-04T00:00:00Z"></article>
<article data-service-review-card-paper="1"><input><div><hr><p data-service-review-text-typography="1">second<img></p></div></article>
<article data-service-review-card-paper="1"><h2 data-service-review-title-typography="1">third</h2></b></article></main>"""
VOID_MAPS = """<div data-review-id="1"><br><span class="wiI7pd">cut text</span><span data-expandable-section="">the whole long text</span></div>
<div class="jJc9Ad"><span class="wiI7pd">no card, since ids are on the page</span></div>
<div data-review-id="2"><img src="x"><div><span class="wiI7pd">another long text<br></span></div></div>"""


def test_void_elements_keep_every_card():
    cards = parse_page(VOID, "trustpilot")
    assert [c.get("text", c.get("title")) for c in cards] == ["onetwo", "second", "third"] and cards[0]["date"] == "2026-03-04"
    assert [c["text"] for c in parse_page(VOID_MAPS, "google_maps")] == ["the whole long text", "another long text"]
    by_class = VOID_MAPS.replace(" data-review-id", " class=\"review-item\" data-x")
    assert len(parse_page(by_class, "google_maps")) == 3
    assert parse_page("", "trustpilot") == parse_page(None, "google_maps") == []


def test_paths_with_spaces(spark):
    import os
    from pyspark.sql import functions as F
    from feedback_spark.sources import files as A
    from feedback_spark.streaming.stream import work_dir

    root = os.path.join(work_dir(spark, "spaces"), "a b+c")
    A.write_layer(spark.createDataFrame([("Country Delight", "x"), ("B", "y"), ("B", "z")], "product string, review_text string").coalesce(1), root, "product", "csv")
    got = {r["folder"].rsplit("=", 1)[1]: r["records"] for r in A.catalogue(spark, root).collect()}
    assert got == {"Country Delight": 1, "B": 2}
    spark.createDataFrame([("[]",)], "value string").coalesce(1).write.text(os.path.join(root, "country delight_response_b01.json"))
    raw = A.read_responses(spark, os.path.join(root, "country delight_response_b01.json"))
    assert raw.select(F.col("file").contains("a b+c/country delight_response_b01.json")).first()[0]


def test_one_prompt_as_a_file(spark):
    import os
    from feedback_spark.sources import files as A
    from feedback_spark.streaming.stream import work_dir

    root = work_dir(spark, "prompts")
    df = spark.createDataFrame([("Country Delight", 1, "a\nb"), ("Country Delight", 2, "c")], "product string, batch_no long, prompt string")
    A.write_prompts(df, os.path.join(root, "table"))
    A.export_prompt(spark, os.path.join(root, "table"), "Country Delight", 1, os.path.join(root, "one"))
    assert [r["value"] for r in spark.read.text(os.path.join(root, "one"), wholetext=True).collect() if r["value"]] == ["a\nb\n"]


def test_cards_leave_the_task_before_the_batch_ends(monkeypatch):
    import pandas as pd

    from feedback_spark.sources import html as H

    card = '<div data-review-id="1"><span class="wiI7pd">{}</span></div>'
    pages = pd.DataFrame([(i, "u", None if i % 10 == 9 else card.format("text " * 100 + str(i)) * 3) for i in range(200)], columns=["page_id", "url", "html"])
    args = ("google_maps", "url", "html", "page_id")
    monkeypatch.setattr(H, "CHARS_AT_ONCE", 10_000, raising=False)
    frames = list(H._frames([pages, pages[:0]], *args))
    assert max(len(f) for f in frames) <= 21 and sum(len(f) for f in frames) == 180 * 3
    monkeypatch.setattr(H, "CHARS_AT_ONCE", 10**9)
    rows = lambda frames: [tuple(map(str, x)) for f in frames for x in f.itertuples(index=False)]
    assert rows(frames) == rows(H._frames([pages], *args))


def test_landed_responses_come_back_by_name(spark, monkeypatch):
    from pyspark.sql import functions as F
    from feedback_spark import session
    from feedback_spark.streaming.stream import work_dir

    rows = [("batches", f"p{k}_response_b{k:02d}.json", f'[{{"a":\n{k}}}]') for k in range(40)]
    rows += [("retry", "p1_response_b01.json", "ü"), ("retry", "p2_response_b02.json", None)]
    responses = spark.createDataFrame(rows, "folder string, name string, body string").coalesce(1)

    def landed():
        root = os.path.join(work_dir(spark, "responses"), "files")
        A.land_responses(responses, root)
        raw = A.read_responses(spark, root, below="*.{json,txt}").withColumn("name", A.landed_name())
        return root, sorted((r["name"], r["body"]) for r in raw.select("name", "body").collect())

    want = sorted((f"{folder}/{name}", f"{body or ''}\n") for folder, name, body in rows)
    root, got = landed()
    assert got == want
    assert sorted(os.listdir(os.path.join(root, "retry"))) == ["p1_response_b01.json", "p2_response_b02.json"]  # no folder per file, no checksums
    monkeypatch.setattr(session, "mounted_path", lambda spark, path: None)  # a store that only Spark reaches
    root, got = landed()
    assert got == want
    tasks = {f.split("-")[1] for _, _, files in os.walk(root) for f in files if f.startswith("part-")}
    assert len(tasks) > 1


def test_responses_are_salvaged_once(spark):
    from feedback_spark.operators import enrich as K

    raw = spark.createDataFrame([("a_response_b01.json", '[{"idx":1,"sentiment":"Positive"},{"idx":2'), ("a_response_b02.json", "sorry")], "file string, body string")
    parsed = K.parse_responses(raw.repartition("file"), 5)
    assert [(r["idx"], r["sentiment"], r["method"]) for r in parsed.collect()] == [(1, "Positive", "salvaged")]
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
