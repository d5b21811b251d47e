"""Relational tables over JDBC and the file manifests.

The readers only assemble Spark's JDBC options; nothing here opens a
connection until Spark runs the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schemas


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    With ``partition_column`` and bounds the scan runs as ``num_partitions``
    parallel range queries instead of one task reading the whole table.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update(properties or {})
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC scan needs lower, upper and num_partitions")
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(num_partitions),
        })
    return opts


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
               **partitioning) -> DataFrame:
    """A relational table as a DataFrame (S1); see :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **partitioning)).load()


def read_table_by_predicates(spark: SparkSession, url: str, table: str, predicates: list[str],
                             properties: dict[str, str] | None = None) -> DataFrame:
    """One task per predicate, e.g. one per month: ``["month = '2024-10-01'", ...]``."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def read_manifest(spark: SparkSession, path: str, failed: bool = False) -> DataFrame:
    """The loaded (or failed) file log stored as Parquet (S9). A log that does
    not exist yet reads as empty."""
    schema = schemas.FAILED_INGESTION_LOG if failed else schemas.INGESTION_LOG
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # path not created yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def done_file_names(spark: SparkSession, loaded_path: str, failed_path: str) -> DataFrame:
    """File names present in either log."""
    loaded = read_manifest(spark, loaded_path).select("file_name")
    failed = read_manifest(spark, failed_path, failed=True).select("file_name")
    return loaded.unionByName(failed).filter(F.col("file_name").isNotNull())
