"""Layers that are published whole.

A layer is a folder of versions and a pointer file::

    <layer>/v<time>-<id>/...    one complete output each, never changed
    <layer>/_current            which version counts, and a few facts about it

A write fills a new version and replaces the pointer last, in one rename, so
whatever ends it halfway leaves the layer as it was, and a reader, which looks
at the pointer once, sees one version from beginning to end.  A writer that
started from a version (a merge) names it; if another writer has published
meanwhile, it fails instead of losing the other's rows.  Old versions stay
readable until ``vacuum``.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from feedback_spark.operators.enrich import merge_incremental

POINTER = "_current"
#: ``based_on`` of a write that replaces whatever is there.
ANY = object()


class StaleLayer(RuntimeError):
    """Another writer has published since the version that a merge started from."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointer(spark: SparkSession, layer: str) -> dict | None:
    at = _path(spark, f"{layer.rstrip('/')}/{POINTER}")
    fs = _fs(spark, layer)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _point(spark: SparkSession, layer: str, facts: dict) -> None:
    """Replace the pointer in one step: a rename over the old one."""
    sc = spark.sparkContext
    new = _path(spark, f"{layer.rstrip('/')}/{POINTER}.{uuid.uuid4().hex}")
    stream = _fs(spark, layer).create(new, False)
    try:
        stream.write(bytearray(json.dumps(facts, sort_keys=True).encode()))
    finally:
        stream.close()
    over = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.isAbsolute() and new.toUri().getScheme() else _fs(spark, layer).getUri(), sc._jsc.hadoopConfiguration())
    files.rename(files.makeQualified(new), files.makeQualified(_path(spark, f"{layer.rstrip('/')}/{POINTER}")), over)


def current_version(spark: SparkSession, layer: str) -> str | None:
    """The version that counts now; None: nothing has been published."""
    found = _pointer(spark, layer)
    return found["version"] if found else None


def facts(spark: SparkSession, layer: str) -> dict:
    """What the last writer noted down about the version that counts."""
    found = _pointer(spark, layer)
    return found["facts"] if found else {}


def new_version() -> str:
    return f"v{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:8]}"


def point_to(spark: SparkSession, layer: str, version: str, based_on=ANY, about: dict | None = None) -> None:
    """Make a complete version the one that counts."""
    if based_on is not ANY and (now := current_version(spark, layer)) != based_on:
        raise StaleLayer(f"{layer}: written from {based_on}, but {now} has been published since")
    _point(spark, layer, {"version": version, "facts": about or {}})


def publish(df: DataFrame, layer: str, partition_by: list[str] | None = None, based_on=ANY, about: dict | None = None) -> str:
    """Write ``df`` as a new version and make it count; returns the version."""
    version = new_version()
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{layer.rstrip('/')}/{version}")
    point_to(df.sparkSession, layer, version, based_on, about)
    return version


def read_layer(spark: SparkSession, layer: str, version: str | None = None) -> DataFrame | None:
    """The layer as it is now (or a version of it that is still there); None: nothing has been published."""
    version = version or current_version(spark, layer)
    return None if version is None else spark.read.parquet(f"{layer.rstrip('/')}/{version}")


def versions(spark: SparkSession, layer: str) -> list[str]:
    """All versions, oldest first, unfinished ones included."""
    fs, at = _fs(spark, layer), _path(spark, layer)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def vacuum(spark: SparkSession, layer: str, keep: int = 2, unfinished_after_s: float = 86_400) -> list[str]:
    """Delete versions older than the last ``keep`` published ones, and unfinished ones of that age; returns their names.

    The version that counts is never deleted, nor one that may still be in the making.
    """
    now, fs, root = current_version(spark, layer), _fs(spark, layer), layer.rstrip("/")
    if now is None:
        return []
    done = {v: fs.exists(_path(spark, f"{root}/{v}/_SUCCESS")) for v in versions(spark, layer)}
    recent = [v for v in done if done[v] and v <= now][-max(1, keep):]
    limit = time.time_ns() // 1000 - int(unfinished_after_s * 1e6)
    gone = [v for v in done if v != now and v not in recent and (v < now if done[v] else int(v[1:18]) <= limit)]
    for v in gone:
        fs.delete(_path(spark, f"{root}/{v}"), True)
    return gone


def merge_publish(spark: SparkSession, layer: str, new: DataFrame, keep: DataFrame | None = None, partition_by: list[str] | None = None) -> str:
    """The layer's rows that are still wanted plus the new ones, staged and swapped in."""
    base = current_version(spark, layer)
    done = read_layer(spark, layer, base) if base else None
    return publish(new if done is None else merge_incremental(done, new, keep), layer, partition_by, based_on=base)
