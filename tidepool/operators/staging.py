"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether a query's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str | None:
    """The checkpoint folder of the session, if it has one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return found.rstrip("/") if found else None


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when each ends; not for frames that are read again as they are."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back; columns of digits take a fraction of the disk that a checkpoint's rows do."""
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_PASSING: list[list[str]] = []


def staged(df: DataFrame) -> DataFrame:
    """Written as Parquet to the checkpoint folder of the session, where it has one, and read back.

    The ordered operators read their input more than once; this keeps the big-integer
    maths before them from being run each time, and survives lost executors.
    """
    top = folder(df.sparkSession)
    if not top:
        return df
    path = f"{top}/tidepool-staged-{uuid.uuid4().hex}"
    kept = write_staged(df, path)
    if _PASSING:
        _PASSING[-1].append(path)
    return kept


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end: what comes out must have been staged by ``finished``."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in _PASSING.pop():
            remove(spark, path)


def finished(df: DataFrame) -> DataFrame:
    """``staged``, but kept when ``passing`` ends."""
    _PASSING.append([])
    try:
        return staged(df)
    finally:
        _PASSING.pop()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a staged table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
