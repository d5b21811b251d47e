"""Writes: partitioned Parquet, versioned tables, relational tables, topics
(K1-K11).

Every write is a Spark job writing from the executors; nothing is collected
on the driver.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import schemas


def write_by_month(trips: DataFrame, path: str, rows_per_file: int = schemas.ROWS_PER_FILE,
                   mode: str = "append", source_col: str | None = None) -> None:
    """Trips as Snappy Parquet under ``month=YYYY-MM-01/`` with at most
    ``rows_per_file`` rows per file (K4, L2).

    Rows are rebalanced by month first: adaptive execution gathers small
    months in one task and cuts a month that holds a large share of the trips
    into tasks of the advisory partition size, from the sizes of the shuffle
    itself. There is no fixed number of partitions and no sampling pass.

    With ``source_col`` (the input file each row came from) the layout is
    ``month=.../<source_col>=.../`` and the write replaces exactly the
    partitions of the sources it contains, so writing a source again (a
    re-run after a failure) replaces its rows instead of adding them.
    """
    w = trips.hint("rebalance", F.col("month")).write
    if source_col:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", source_col)
    else:
        w = w.mode(mode).partitionBy("month")
    w.option("maxRecordsPerFile", rows_per_file).option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      mode: str = "overwrite") -> None:
    """Partitioned Parquet (K7, K11). With the session's dynamic partition
    overwrite, ``overwrite`` replaces only the partitions present in ``df``,
    so re-running a day's load is idempotent."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_run(df: DataFrame, path: str, run_col: str, run: str, partition_by: list[str]) -> None:
    """The rows of one run below ``<run_col>=<run>/``, replacing what an
    earlier try of the same run wrote there and nothing else (K11)."""
    df.drop(run_col).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/{run_col}={run}")


# -- versioned tables: readers see a complete version or the previous one -----

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder whose contents have been used."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def folder_files(spark: SparkSession, path: str) -> int:
    """Number of all files below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getFileCount()


def versions(spark: SparkSession, table_path: str) -> list[str]:
    """Committed version folders (``v=<n>`` with ``_SUCCESS``), oldest first."""
    fs, root = _fs(spark, table_path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and fs.exists(
            spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
        ):
            out.append(name)
    return sorted(out, key=lambda n: int(n[2:]))


def read_current(spark: SparkSession, table_path: str, schema: StructType) -> DataFrame:
    """The newest committed version of a versioned table (empty if none)."""
    vs = versions(spark, table_path)
    if not vs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table_path.rstrip('/')}/{vs[-1]}")


def commit_version(df: DataFrame, table_path: str, keep: int = 3, keep_seconds: int = 7 * 86_400) -> str:
    """Write ``df`` as a new version folder; it becomes current once Spark's
    commit writes ``_SUCCESS``. The folder being read is never overwritten,
    so an upsert computed from the current version can be written safely
    (K8). Versions beyond the newest ``keep`` are removed once they are older
    than ``keep_seconds``, so that running readers do not lose theirs."""
    spark = df.sparkSession
    version = f"v={time.time_ns()}"
    out = f"{table_path.rstrip('/')}/{version}"
    df.write.mode("errorifexists").parquet(out)
    fs, _ = _fs(spark, table_path)
    for old in versions(spark, table_path)[:-keep]:
        if time.time_ns() - int(old[2:]) > keep_seconds * 1_000_000_000:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_path.rstrip('/')}/{old}"), True)
    return out


# -- catalog tables -----------------------------------------------------------

def ensure_table(spark: SparkSession, name: str, schema: StructType, location: str,
                 partition_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a declared schema."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{location}'"
    )


# -- relational and topic sinks -----------------------------------------------

def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", batch_size: int = schemas.LOAD_BATCH_ROWS,
               num_partitions: int | None = None) -> None:
    """Append to a relational table in ``batch_size``-row batches, one
    connection per task (K1, K6); failed tasks are retried by Spark."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    w = w.option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """``key, value`` messages to the topic (K3)."""
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


def write_snapshots(docs: DataFrame, path: str) -> None:
    """Feed documents as text files, one folder per snapshot time and one
    document per file, so each file reads back whole (K5)."""
    (
        docs.select(F.date_format("snapshot_time", "yyyyMMddHHmmss").alias("snapshot"), "doc")
        .write.mode("append").option("maxRecordsPerFile", 1).partitionBy("snapshot").text(path)
    )
