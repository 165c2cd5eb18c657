"""Shared scratch space: reliable checkpoints and staging folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"rosterloom-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Computes a table once and cuts its lineage with a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`stored` makes in this block are deleted at its end; write the result inside."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            discard(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Computes a fact-sized table once, as Parquet in the shared folder, to be read by column.

    Unlike a checkpoint, readers take the columns they want.  The table lasts as long as the enclosing
    :func:`scratch` block; without one it stays in the shared folder.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def relay(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """For rounds that each read the table of the one before: stores a table as Parquet, then deletes the one before; the last goes with the block.

    The next plan sees the table's true size.  A checkpoint hands on the estimate of its plan instead, and that of a join is the product
    of its sides: squared round by round, it becomes a number of millions of digits that the planner multiplies.
    """
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        paths.append(staging_path(spark, name))
        df.write.parquet(paths[-1])
        while len(paths) > 1:
            discard(spark, paths.pop(0))
        return spark.read.schema(df.schema).parquet(paths[0])

    try:
        yield keep
    finally:
        for path in paths:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a staged table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
