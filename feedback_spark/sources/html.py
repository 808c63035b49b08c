"""Review cards out of landed HTML pages.

Each page is parsed independently inside ``mapInPandas`` (Arrow batches of
pages, one small ``html.parser`` state machine per page), so the work is
spread over the page table's partitions and nothing is collected.  Only the
elements the reference markup uses are tracked.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

OUT_SCHEMA = ("page_id long, card int, platform string, date string, author string, rating double, "
              "review_text string, source_url string")
# Class names and labels of the review pages' markup.
_STAR = re.compile(r"(\d+)\s+star")
_MAPS_TEXT = re.compile(r"review-full-text|wiI7pd|Jtu6Td")
_MAPS_DATE = re.compile(r"dehysf|rsqaWe")
_MAPS_AUTHOR = re.compile(r"d4r55|TSUbDb")
_MAPS_ITEM = re.compile(r"review-item|jJc9Ad|WMbnJf")
_MAPS_ID = re.compile(r"<div\b[^>]*\sdata-review-id", re.I)
# HTML elements that have no end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Cards(HTMLParser):
    """Collect per-card fields; ``kind`` selects the markup rules, ``by_id`` what opens a map card."""

    def __init__(self, kind: str, by_id: bool = True):
        super().__init__(convert_charrefs=True)
        self.kind, self.by_id = kind, by_id
        self.cards: list[dict] = []
        self.open: list[tuple[str, str | None]] = []  # tags not closed yet, each with the field it captures ("card": the card)

    def _opens_card(self, tag: str, a: dict) -> bool:
        if self.kind == "trustpilot":
            return tag == "article" and "data-service-review-card-paper" in a
        return tag == "div" and ("data-review-id" in a if self.by_id else bool(_MAPS_ITEM.search(a.get("class", ""))))

    def _field(self, tag: str, a: dict, card: dict) -> str | None:
        """The field whose text this element holds; values held in attributes are stored at once."""
        cls, label = a.get("class", ""), a.get("aria-label", "")
        if self.kind == "trustpilot":
            if tag == "div" and "data-service-review-rating" in a:
                card.setdefault("rating", a["data-service-review-rating"])
            elif tag == "time":
                card.setdefault("date", a.get("datetime", "")[:10])
            elif tag == "aside":
                card.setdefault("author", label.replace("Info for ", ""))
            field = {"p": "text" if "data-service-review-text-typography" in a else None,
                     "h2": "title" if "data-service-review-title-typography" in a else None}.get(tag)
        else:
            if star := _STAR.search(label):
                card.setdefault("rating", star.group(1))
            field = None
            if tag == "span":
                field = "expanded" if "data-expandable-section" in a else "text" if _MAPS_TEXT.search(cls) else "date" if _MAPS_DATE.search(cls) else None
            elif tag == "div" and _MAPS_AUTHOR.search(cls):
                field = "author"
        return field if field not in card else None

    def handle_starttag(self, tag, attrs):
        a = {k: (v if v is not None else "") for k, v in attrs}
        inside = any(f == "card" for _, f in self.open)
        field = None
        if inside:
            field = self._field(tag, a, self.cards[-1])
            if field:
                self.cards[-1][field] = ""
        elif self._opens_card(tag, a):
            self.cards.append({})
            field = "card"
        if tag not in _VOID:
            self.open.append((tag, field))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:  # also ends what was left open inside; an end tag of nothing is ignored
                del self.open[i:]
                return

    def handle_data(self, data):
        for _, field in self.open:
            if field and field != "card":
                self.cards[-1][field] += data.strip()


def parse_page(html: str | None, kind: str) -> list[dict]:
    """Cards of a page; a page cut short yields the cards read so far."""
    p = _Cards(kind, by_id=bool(_MAPS_ID.search(html or "")))
    p.feed(html or "")
    p.close()
    for card in p.cards:
        if "expanded" in card:
            card["text"] = card.pop("expanded")
    return p.cards


def _rows(kind: str, page_id, url, html):
    out = []
    for i, c in enumerate(parse_page(html, kind)):
        rating = c.get("rating", "")
        if kind == "trustpilot":
            text = (c.get("title", "") + " " + c.get("text", "")).strip()
            if not text:
                continue
            rating_v = float(rating) if rating.isdigit() else None
        else:
            text = c.get("text", "")
            if len(text.strip()) < 10:
                continue
            rating_v = float(rating) if rating else None
        out.append({"page_id": None if page_id is None or page_id != page_id else int(page_id), "card": i, "platform": kind, "date": c.get("date", ""),
                    "author": c.get("author", ""), "rating": rating_v, "review_text": text, "source_url": url})
    return out


#: Characters of pages after which the cards read so far leave the task.
CHARS_AT_ONCE = 1_000_000


def _frames(batches, kind: str, url_col: str, html_col: str, key: str):
    """The cards of batches of pages, in frames of few pages: a batch's cards are never held together."""
    columns = [f.split()[0] for f in OUT_SCHEMA.split(", ")]
    for b in batches:
        rows, read = [], 0
        for pid, url, html in zip(b[key], b[url_col], b[html_col]):
            rows.extend(_rows(kind, pid, url, html))
            read += len(html or "")
            if read >= CHARS_AT_ONCE:
                yield pd.DataFrame(rows, columns=columns)
                rows, read = [], 0
        yield pd.DataFrame(rows, columns=columns)


def parse_pages(pages: DataFrame, kind: str, url_col: str = "url", html_col: str = "html", key: str = "page_id") -> DataFrame:
    from feedback_spark.session import ship_package

    ship_package(pages.sparkSession)

    def fn(batches):
        yield from _frames(batches, kind, url_col, html_col, key)

    return pages.select(key, url_col, html_col).mapInPandas(fn, OUT_SCHEMA)
