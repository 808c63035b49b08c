"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Query-level defaults; each is set only where the deployment (spark-submit, spark-defaults) has not.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "feedback_spark") -> SparkSession:
    """Session with the settings the operators assume (AQE on, UTC).

    Master, memory and partition counts come from the deployment.  Of the
    query-level defaults only those are set that the session's configuration
    does not name; ``shuffle_partitions`` (for local runs) likewise yields to
    an explicit ``spark.sql.shuffle.partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    event_log = os.environ.get("FEEDBACK_EVENT_LOG")  # optional: stage/task times for profiling
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    memory = os.environ.get("FEEDBACK_DRIVER_MEMORY")  # local runs start the JVM themselves
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    wanted = dict(SQL_DEFAULTS)
    if shuffle_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in wanted.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must set it to shared storage; only a local session (one
    machine) gets a fresh scratch folder when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it must name a folder that all machines share")
        current = tempfile.mkdtemp(prefix="feedback-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedback_spark`` importable in Python workers (once per context).

    The Arrow functions and ``mapInPandas`` jobs are defined in this package;
    workers started outside the repository (another working directory, a
    cluster without --py-files) could not unpickle them.  The package is
    zipped on the driver and distributed with ``addPyFile``, as ``--py-files``
    would do.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="feedback-pyfiles-"), "feedback_spark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of ``path`` (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The plain path of a shared folder that is mounted on the machines (``file:``); None: it is in another store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def input_state(spark: SparkSession, path: str) -> str:
    """What identifies the present content of a table's folder or file: names, sizes and times of its files."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return ";".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p)))


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
