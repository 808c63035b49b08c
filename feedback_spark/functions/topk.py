"""Exact top-k per group that survives a hot group.

``row_number() over (partition by g order by o) <= k`` is planned with a
partial group limit below the exchange: every task keeps its k best rows of a
group before anything is shuffled, so a group that holds a third of all rows
reaches its final task as at most k rows from each task.  Spark does this for
k up to ``spark.sql.window.group.limit.threshold`` (1000); callers project to
the columns they need first, so that only those are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each ``group`` in ``order`` (unique at its end); add ``rank`` (1..k)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k).withColumn(rank_col, F.col(rank_col).cast("long"))
