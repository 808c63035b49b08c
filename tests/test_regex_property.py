"""Property: the portable form of every fixed pattern agrees with Python ``re``
(the original semantics) in DuckDB on random review-like text."""

import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from feedback_spark import fixed_values as FV
from feedback_spark.functions.regex import portable

WORDS = ["late", "delivery", "deliver", "on time", "on-time", "app", "café", "refund", "wise", "otherwise",
         "please add", "cancelled my sub", "switched to", "would love to see", "i wish it had", "broker",
         "p&l", "vs excel", "dark mode", "helped me", "finally profitable", "doesn't work", "über", "ñandú",
         "2fa", "id", "kyc", "x", "", "é"]
SEPS = [" ", "  ", "\n", ", ", ". ", "!", "-", "_", "é", " ", "\t"]

PATTERNS = ([p for lst in FV.THEME_PATTERNS.values() for _, p in lst]
            + [p for lst in FV.COMPETITOR_PATTERNS.values() for _, p in lst]
            + [FV.SUCCESS_STORY_PATTERN, FV.PRODUCT_COMPLAINT_PATTERN, FV.FEATURE_REQUEST_PATTERN,
               FV.REQUEST_SUPPRESS_PATTERN, FV.CHURN_PATTERN])
CON = duckdb.connect()

texts = st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SEPS)), min_size=1, max_size=8).map(
    lambda parts: "".join(w + s for w, s in parts))


@settings(max_examples=80, deadline=None, derandomize=True)
@given(texts)
def test_portable_matches_python(text):
    lc = text.lower()
    for p in PATTERNS:
        want = re.search(p, lc) is not None
        got = CON.execute("SELECT regexp_matches(?, ?)", [lc, portable(p)]).fetchone()[0]
        assert got == want, (p, text)
