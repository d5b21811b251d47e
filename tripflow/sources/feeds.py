"""Landed feed snapshots: one JSON document per file, named with its fetch
time ``..._yyyyMMddHHmmss.json`` (S3, S4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import functions as tf


#: Landed feed documents: as polled (.json) or as written by ``sinks.write_snapshots`` (.txt).
SNAPSHOT_FILES = "*.{json,txt}"


def _shape(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_metadata.file_path").alias("source"),
        tf.snapshot_time(F.col("_metadata.file_path")).alias("snapshot_time"),
        F.col("value").alias("doc"),
    )


def read_snapshots(spark: SparkSession, path: str, glob: str = SNAPSHOT_FILES) -> DataFrame:
    """``source, snapshot_time, doc``: every landed snapshot under ``path``.

    A snapshot is one bounded document (one entry per station), read whole
    as one row; files are spread over tasks.
    """
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).text(path, wholetext=True)
    )
    return _shape(df)


def stream_snapshots(spark: SparkSession, path: str, glob: str = SNAPSHOT_FILES,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form of :func:`read_snapshots`: each new file once (T4)."""
    r = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _shape(r.text(path, wholetext=True))
