"""Session settings the library relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_made: set[str] = set()

#: Settings of runs that write many tables: a query's shuffle files go when it ends, not when the driver happens to collect garbage, and a task
#: that has rows of a few folders only writes them as they come, without a sort that spills.
WRITES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "32"}


def build_session(app_name: str = "ordermill", master: str | None = None, **conf: object) -> SparkSession:
    """A session with a UTC clock and adaptive execution.

    `conf` adds or overrides settings, with `__` for the dots: `spark__sql__shuffle__partitions=4000`.
    Adaptive execution merges small shuffle partitions but does not add any, so a large cluster
    should start from many. ANSI mode stays at Spark's default (on): bad input is handled with try_* functions,
    and an overflow raises instead of turning into NULL.
    Errors do not name the Python line of each column expression: collecting those lines takes longer than planning a small report.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def for_writes(spark: SparkSession) -> Iterator[None]:
    """The settings `WRITES` for a while; afterwards the session has its own again."""
    before = {key: spark.conf.get(key, None) for key in WRITES}
    for key, value in WRITES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between jobs, as named by `spark.checkpoint.dir`; without it, one in the warehouse.

    On a cluster both must be folders that every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def file_system(spark: SparkSession, folder: str) -> tuple:
    """Hadoop's path of a folder and the file system that it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one. It is removed when the session's JVM ends, or by `drop_folder`."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path, system = file_system(spark, folder)
    system.mkdirs(path)
    system.deleteOnExit(path)
    _made.add(folder)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that `new_folder` made in this run; no other is touched."""
    if folder not in _made:
        raise ValueError(f"{folder} was not made by this run")
    path, system = file_system(spark, folder)
    system.delete(path, True)
    _made.discard(folder)
