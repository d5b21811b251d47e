"""Readers. Each returns a DataFrame with a declared schema; nothing is read
until an action runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of a scan, as stored, that one task gets after a spread.
TASK_SCAN_BYTES = 8 << 20


def spread_scan(df: DataFrame, keys: list[str], task_bytes: int = TASK_SCAN_BYTES) -> DataFrame:
    """Hash-spread a scan by ``keys`` (a row id) over the cores, or over tasks of
    ``task_bytes`` where it is larger than that. A row group is read by one
    task, so a file of few row groups makes few tasks however large it is. The
    size is Spark's own estimate, the files' bytes.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), *keys)
