"""feedback_spark: customer-feedback analytics as lazy Spark DataFrame operators.

Layout
------
functions/   Column-level helpers (text cleaning, regex dialect, labels)
sources/     readers, landed-payload adapters, sinks, the ``reviews`` adapter
operators/   DataFrame -> DataFrame operators, one module per family (C..K)
plans/       the query registry and its DuckDB oracle SQL
streaming/   Structured Streaming variants (M1-M3)
"""

from feedback_spark.session import get_spark, checkpoint_dir  # noqa: F401
