"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark.session import checkpoint_dir, ship_package

#: Rows per Arrow batch: texts can be very long, so batches are kept small.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_prefix(df: DataFrame) -> str:
    """A beginning of names that no column of ``df`` has: names of helper columns start with it."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def all_columns(df: DataFrame) -> list[str]:
    """The columns' names, quoted (names may hold dots)."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]


def python_ready(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before a plan with Python tasks: ship the package, keep Arrow batches small (``rows`` at most)."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


#: Rows of a narrow table that one task writes.
ROWS_A_TASK = 100_000


def materialise(df: DataFrame, label: str, path: str | None = None, rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back (cuts the lineage).

    ``rows``: about how many rows a table just shuffled has at most; its last
    stage then runs in as many tasks as these need, and writes no tiny files.
    ``codec``: the files' compression (None: the session's).
    """
    path = path or new_folder(df.sparkSession, label)
    out = df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_TASK)))
    out.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's decimal text, modulo ``folds`` (null keys: null)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))
