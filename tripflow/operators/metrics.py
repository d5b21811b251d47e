"""Counts over trips and station tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import functions as tf


def trips_per_month(trips: DataFrame, month: str = "month") -> DataFrame:
    """Trips per month (A3): ``month, trip_count``."""
    return trips.groupBy(month).agg(F.count(F.lit(1)).alias("trip_count"))


def trips_per_day(trips: DataFrame, started_at: str = "started_at", ride_id: str = "ride_id") -> DataFrame:
    """Distinct rides per start day (A7): ``day, trip_count``.

    Spark plans the distinct count as an aggregate on (day, ride_id) first, so
    the shuffle is spread by ride even when one day holds most trips.
    """
    return trips.groupBy(tf.to_day(started_at).alias("day")).agg(
        F.count_distinct(ride_id).alias("trip_count")
    )


def rows_per_file(rows: DataFrame, month: str = "month") -> DataFrame:
    """``month, source_file, n, places``: rows of each file that has been read
    with its lineage, and different places among them. Places are counted by
    bitmap, one of fixed size for 32,768 places in a row, so no row is shuffled.
    """
    place = F.col("source_row")
    pieces = rows.groupBy(month, "source_file", F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("places"))
    return pieces.groupBy(month, "source_file").agg(F.sum("n").alias("n"), F.sum("places").alias("places"))


def total_records(spark: SparkSession, df: DataFrame, view: str) -> DataFrame:
    """Register ``df`` as a temp view and count it with SQL (A2, Q1, Q2)."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT COUNT(*) AS total_records FROM `{view}`")


def defects_per_month(trips: DataFrame, month: str = "month") -> DataFrame:
    """Per month: rows without ride_id, and rows without start or end time (A4).

    Meant for the frame *before* rows with nulls are dropped.
    """
    return trips.groupBy(month).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("ride_id").isNull()).alias("no_ride_id"),
        F.count_if(F.col("started_at").isNull() | F.col("ended_at").isNull()).alias("no_start_or_end"),
    )


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: total rows and the null count of every column, in one pass (A5).

    Columns are ``rows`` and ``null_<column>``.
    """
    cols = columns or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for a look at a table (L1); a limit is the
    feature here, the jobs never use it."""
    return df.limit(n)
