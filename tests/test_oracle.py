"""Every registered query against its DuckDB oracle (sf0.001 by default).

Set FEEDBACK_TEST_SF=/root/testdata/sf0.01 for the driver's scale.
"""

import pytest

import __spark_entry__ as E
from feedback_spark.plans.registry import all_queries
from feedback_spark.plans.compare import compare, duck

from conftest import SF_ORACLE

QUERIES = {name: spec[0] for name, spec in all_queries().items()}
SQL = {name: spec[1] for name, spec in all_queries().items() if spec[1] is not None}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_ORACLE, name, QUERIES[name], SQL.get(name), con)
    assert res["status"] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "theme" in df.columns
