"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Of local sessions, where driver and executors are one machine.
LOCAL_FOLDER = "/tmp/spark-scanloom-shared"
#: Spark removes the shuffle files of a query as soon as it ends, if this is set.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables that the innermost open `scratch` will delete.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, the context's own checkpoint folder; where there is none either, a local folder
    that becomes it, if the session is local. On a cluster without a shared folder this raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if own := sc.getCheckpointDir():
        return own.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(LOCAL_FOLDER)
    return LOCAL_FOLDER


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What queries in this block shuffled goes when they end; else it stays on disk until the driver collects garbage."""
    was = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if was is None else spark.conf.set(FREE_SHUFFLES, was)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again. Lost executors cost nothing that was written. The table stays, as results
    read it lazily, unless a `scratch` is open; let the folder expire."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Outlives:
    """What a `scratch` gives: tables made by `result` stay when it ends, and are those of the scratch around it, if any."""

    def __init__(self, around: list[str] | None) -> None:
        self.around = around

    def result(self, df: DataFrame, name: str) -> DataFrame:
        inner = _passing.set(self.around)
        try:
            return materialise(df, name)
        finally:
            _passing.reset(inner)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Outlives]:
    """Tables that are materialised in this block are deleted at its end, so that a job of many steps doesn't hold them all. What
    leaves the block must not read them: pass it through `result`."""
    paths: list[str] = []
    around = _passing.get()
    opened = _passing.set(paths)
    try:
        yield Outlives(around)
    finally:
        _passing.reset(opened)
        for path in paths:
            delete(spark, path)
