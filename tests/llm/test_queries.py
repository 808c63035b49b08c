import re

import __spark_entry__ as E
from feedback_spark.llm.queries import QUERIES


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(E.oracle_sql()) & set(QUERIES) == {"op5_exact_topk"}


def test_native_queries_run_no_python(spark):
    for name in ("op2_mix_sources", "op7_secret_scan"):
        plan = QUERIES[name][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
