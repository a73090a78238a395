"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "scholarmill") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode.

    Whoever sets it on a cluster names a folder that all executors share, on HDFS, an object store or
    a mount; a ``file:`` address may be such a mount, so it is taken at its word.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="scholarmill-"))
    return context.getCheckpointDir()


_STORED: dict[str, list[str]] = {}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> int:
    """Delete the unnamed intermediate tables and folders of this application; returns their number.

    Call it when the results of the queries that made them have been written.
    """
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder of the shared store, deleted by ``release``."""
    path = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a job when the job is done, not when its driver forgets it."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)


def stored(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Row numbers and slice numbers drawn while sorting stay fixed afterwards, whichever executor is
    lost, and readers of the table may prune columns. A repeating job passes its own ``name`` so that
    each run replaces the table of the run before; the others stay until ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{name or uuid.uuid4().hex}"
    if not name:
        _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    with _tidy(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for table in tables:
        for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            remove(table.sparkSession, path)
