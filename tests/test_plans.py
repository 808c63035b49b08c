"""

* no row-at-a-time Python UDF anywhere (Arrow-batched evaluation only, and
  only in the operators that need Python);
* the ``documents`` scan reads only the columns a query uses;
* no window without a partition key over a large input (only the tiny
  per-partition offsets of C8 use one).
"""

import re

import pytest

from feedback_spark.plans.registry import all_queries

from conftest import SF_SMALL

QUERIES = {name: spec[0] for name, spec in all_queries().items()}
SKIP = ("m1_", "m2_", "m3_", "a1_", "a4_", "a5_", "a8_")   # these run a job while they are built


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(SKIP)))
def test_plan_properties(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan, name
    lines = plan.splitlines()
    for i, line in enumerate(lines):  # a window over one partition: only C8's offsets, a row per partition
        if " Window [" in line and any("Exchange SinglePartition" in x for x in lines[i + 1:i + 4]):
            assert "_cnt" in line, (name, line)
    for schema in re.findall(r"ReadSchema: (struct<[^\]]*?>)(?:,|$|\])", plan):
        if "doc_id" in schema and "text" in schema:
            assert "lang" not in schema and "source:" not in schema, (name, schema)


def test_layer_plans(spark):
    """The layer builds: pruned documents scan, one dedup exchange, Arrow scoring after dedup."""
    from feedback_spark.plans.base import scored_plan

    plan = _plan(scored_plan(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^\]]*?>)", plan)
    assert schemas and all("lang" not in s and "source:" not in s for s in schemas)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" in plan
    assert plan.index("ArrowEvalPython") < plan.index("Exchange")      # scoring sits above the dedup exchange


def test_python_only_where_needed(spark):
    """Python runs only as the lexicon scorer, the JSON salvage or the HTML card parser."""
    allowed = {"score", "_salvage_batch", "fn"}
    seen = set()
    for name, fn in QUERIES.items():
        if name.startswith(SKIP):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        names = set(re.findall(r"ArrowEvalPython \[(\w+)\(", plan)) | set(re.findall(r"MapInPandas (\w+)\(", plan))
        assert names <= allowed, (name, names)
        seen |= names
    assert seen == allowed
