"""All registered queries: name -> (spark_fn(spark, sf_dir), oracle_sql or None)."""

from __future__ import annotations

import importlib

MODULES = ["q_core", "q_metrics", "q_trends_explore", "q_text", "q_enrich", "q_sources", "q_streaming", "q_files"]


def all_queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(importlib.import_module(f"feedback_spark.plans.{m}").QUERIES)
    return out
