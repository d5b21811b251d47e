"""Shared helpers: reading the tables, cutting lineage with written tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripflow import sinks
from tripflow.session import fresh_dir

#: Rows per Arrow batch handed to Python: texts are long, so batches stay small.
ARROW_ROWS = 512
#: Bytes of such a batch, where rows are longer.
ARROW_BYTES = 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_conf(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


_collecting: list[list[str]] = []


@contextmanager
def collected() -> Iterator[list[str]]:
    """The folders that :func:`saved` makes inside the block."""
    _collecting.append([])
    try:
        yield _collecting[-1]
    finally:
        _collecting.pop()


def discard(spark: SparkSession, folders: list[str], *keep: DataFrame) -> None:
    """Delete the ``folders`` of :func:`saved` tables whose contents have been
    used, all but those of the tables to ``keep``."""
    for folder in list(folders):
        if folder not in [df._folder for df in keep]:
            sinks.remove(spark, folder)
            folders.remove(folder)


def saved(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read
    it back: the lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    path = fresh_dir(spark, kind)
    df.write.parquet(path)
    for folders in _collecting:
        folders.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out

