"""A: file sources, sinks and the dataset catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedback_spark.sources.payloads import REVIEW_SCHEMA

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}


def plain_path(col: str) -> Column:
    """``_metadata.file_path`` as it is on disk: the reader gives it URL-encoded."""
    return F.url_decode(F.replace(F.col(col), F.lit("+"), F.lit("%2B")))


def read_reviews(spark: SparkSession, path: str, schema: str = REVIEW_SCHEMA) -> DataFrame:
    """A1: review CSV whose texts hold newlines, quotes and commas.

    ``multiLine`` + ``escape='"'`` read quoted multi-line fields as one record
    (the default options split them into many); the schema is fixed, never
    inferred.  Rating is read as text and coerced with ``try_cast`` so a stray
    value becomes null instead of failing the read.
    """
    text_schema = ", ".join(f"{c.split()[0]} string" for c in schema.split(", "))
    df = spark.read.options(**CSV_OPTIONS).schema(text_schema).csv(path)
    casts = []
    for c in schema.split(", "):
        name, typ = c.split()
        casts.append(F.col(name).try_cast(typ).alias(name) if typ != "string" else F.col(name))
    return df.select(*casts)


def resolve_tier(spark: SparkSession, paths: list[str], schema: str = REVIEW_SCHEMA, fmt: str = "csv") -> DataFrame:
    """A2: read the first existing path of an ordered list (enriched -> clean -> raw);
    none -> an empty frame with the schema.  The existence test is a metadata call."""
    from feedback_spark.session import path_exists

    for p in paths:
        if p and path_exists(spark, p):
            return read_reviews(spark, p, schema) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(p)
    return spark.createDataFrame([], schema)


def write_layer(df: DataFrame, path: str, partition_by: str | None = "product", fmt: str = "parquet") -> None:
    """A4: overwrite a whole output layer (optionally partitioned)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true").option("escape", '"')
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.save(path)


def land_responses(responses: DataFrame, path: str) -> None:
    """Response files (folder, name, body), one file each, written by all tasks.

    A file costs far more than its few bytes, so the rows are dealt by number over
    the tasks (their size alone would put them into one).  In a folder that the
    machines have mounted the tasks write ``path``/<folder>/<name> themselves:
    Hadoop's local file system starts two ``chmod`` processes per file, which takes
    longer than all the rest.  Another store gets
    ``path``/folder=<folder>/name=<name>/<part>.txt from Spark's writer, whose tasks
    move their own files into place.  Rows of one name become lines of one file.
    """
    from feedback_spark.session import mounted_path

    spark = responses.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = responses.select("folder", "name", "body").repartition(tasks, "folder", "name")
    root = mounted_path(spark, path)
    if root is None:
        (rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .partitionBy("folder", "name").text(path))
        return

    def write(part) -> None:
        import os
        import uuid
        from itertools import groupby

        for (folder, name), same in groupby(part, key=lambda r: (r["folder"], r["name"])):
            os.makedirs(os.path.join(root, folder), exist_ok=True)
            # a whole file appears at once, also if two attempts of a task write it
            half = os.path.join(root, folder, f".{uuid.uuid4().hex}")
            with open(half, "w", encoding="utf-8", newline="") as f:
                f.writelines(f"{r['body'] or ''}\n" for r in same)
            os.replace(half, os.path.join(root, folder, name))

    rows.sortWithinPartitions("folder", "name").foreachPartition(write)


def landed_name(file: str = "file") -> Column:
    """``<folder>/<name>`` of a file that ``land_responses`` has written, by its path."""
    dealt = r"/folder=([^/]+)/name=([^/]+)/[^/]+$"
    return (F.when(F.col(file).rlike(dealt), F.concat(F.regexp_extract(file, dealt, 1), F.lit("/"), F.regexp_extract(file, dealt, 2)))
            .otherwise(F.regexp_extract(file, r"([^/]+/[^/]+)$", 1)))


def read_responses(spark: SparkSession, glob: str, below: str | None = None) -> DataFrame:
    """A5: response files as (file, body, batch_no), one row per file.

    ``wholetext`` keeps a file in one row; the file name comes from the
    ``_metadata`` column and the batch number from its ``_bNN.json`` suffix.
    With ``below`` (a pattern of file names) ``glob`` names folders, and all such
    files anywhere below them are read: tasks list the folders, while a glob over
    many folders is resolved one by one on the driver.
    """
    reader = spark.read
    if below is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", below)
    df = reader.text(glob, wholetext=True).select(plain_path("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    return df.withColumn("batch_no", F.regexp_extract("file", r"_b(\d+)\.json$", 1).try_cast("long"))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header and quoted fields (embedded quotes doubled)."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "false").csv(path))


def catalogue(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """Datasets under ``root``: folder, file, records, size KB, modified.

    Sizes and times come from the ``binaryFile`` listing (content not read);
    records are counted by reading the CSVs with multi-line-aware options,
    grouped by ``_metadata.file_path`` (the original counted physical lines,
    which over-counts multi-line texts).
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
               .load(root).select("path", "length", "modificationTime"))
    counts = (spark.read.options(**CSV_OPTIONS).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).csv(root)
              .select(plain_path("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("records")))
    bare = F.regexp_replace("path", "^(\\w+):/+", "$1:/")  # file:/x and file:///x are one path
    counts, listing = counts.withColumn("path", bare), listing.withColumn("path", bare)
    empty = F.when(F.col("length") == 0, F.lit(0))  # a file that the count did not match stays null otherwise
    return (listing.join(counts, "path", "left")
            .select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"),
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
                    F.coalesce("records", empty).alias("records"),
                    F.round(F.col("length") / 1024, 1).alias("size_kb"), F.col("modificationTime").alias("modified")))


def write_prompts(prompts: DataFrame, path: str) -> None:
    """The prompts as one table (product, batch_no, prompt), a folder per product."""
    prompts.select("product", "batch_no", "prompt").write.mode("overwrite").partitionBy("product").parquet(path)


def export_prompt(spark: SparkSession, table: str, product: str, batch_no: int, path: str) -> None:
    """One batch's prompt of the table as a text file in ``path``."""
    one = spark.read.parquet(table).filter((F.col("product") == product) & (F.col("batch_no") == batch_no)).select("prompt")
    one.write.mode("overwrite").text(path)
