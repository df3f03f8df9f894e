"""Cutting lineage between the rounds of an iteration, and passing files, in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset a local master gets a temporary one; on a cluster that is an error,
    as each executor would write to its own disk."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None) or (held.get() if held.isDefined() else None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="pluvia-")
    if not held.isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/pluvia/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows of df as a table written in the shared folder; lineage ends there. (A checkpoint would work the rows out twice.)"""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which a finished query's shuffle files go at once; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Tables that are written meanwhile leave no shuffle files behind."""
    held = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if held is None else spark.conf.set(_CLEANUP, held)
