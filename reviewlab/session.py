"""Session helpers: a local session for tests, and tables kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Paths given out inside the innermost scratch_scope.
_given: ContextVar[list[str] | None] = ContextVar("given", default=None)


def local_session(cores: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reviewlab")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="reviewlab-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; every call gives another one."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (given := _given.get()) is not None:
        given.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, when the block ends, what ``scratch_path`` and ``materialize`` wrote inside it.

    Results must be written out before, as they still read those tables. PySpark has no call for
    files, so Hadoop's file system is asked through the gateway.
    """
    with scratch_list() as given:
        try:
            yield
        finally:
            delete_paths(spark, given)


@contextmanager
def scratch_list() -> Iterator[list[str]]:
    """The paths given out inside the block; deleting them is left to the caller."""
    given: list[str] = []
    token = _given.set(given)
    try:
        yield given
    finally:
        _given.reset(token)
        if (outer := _given.get()) is not None:
            outer.extend(given)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders; those that are gone already are passed over."""
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several passes will read, and return the scan of it.

    The written copy outlives lost executors, cuts the lineage, and can be pruned by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
