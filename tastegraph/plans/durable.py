"""Lineage cuts and scratch folders that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"
# Rows go to Python workers in batches of at most so many bytes while a table is written: wide rows (whole sets, texts) would
# otherwise fill 64 MB several times over for each core.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
# Paths handed out, for ``scratch``.
_paths: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one on local masters only."""
    context = spark.sparkContext
    named = spark.conf.get(CONF, None) or context.getConf().get(CONF)
    if named:
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError(f"set {CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tastegraph-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the operators called inside have written to the shared folder.

    Results must have been written or collected inside, since they are read from those tables.
    """
    before = len(_paths)
    try:
        yield
    finally:
        mine, _paths[before:] = _paths[before:], []
        for path in mine:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Arrow batches of at most so many bytes for the jobs started inside."""
    before = spark.conf.get(BATCH_CONF)
    given = int(before.rstrip("b")) if before.rstrip("b").lstrip("-").isdigit() else 0
    if 0 < given <= most:
        yield
        return
    spark.conf.set(BATCH_CONF, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def durable(df: DataFrame) -> DataFrame:
    """Write the frame as a table in the shared folder and go on from its files.

    For frames that several branches of a plan read: each branch would otherwise run its source
    again. The plan ends here, a lost executor costs a re-read, and the file sizes give the optimizer
    true statistics, so that it broadcasts only what is small. ``scratch`` deletes the tables of a block of calls.
    """
    path = scratch_path(df.sparkSession, "table")
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_ready(spark: SparkSession) -> None:
    """Make sure that library code that checkpoints by itself has a folder to do so."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
