"""Structured Streaming jobs.

The transformations are the batch functions of :mod:`tripflow.operators`;
only the source, trigger and sink differ. Every query has a checkpoint, and
each micro-batch is written under its own ``batch_id`` partition with
dynamic overwrite, so a batch replayed after a failure replaces its own
output instead of duplicating it (D10).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow import functions as tf
from tripflow import schemas, sinks
from tripflow.operators import feeds, quality, tables
from tripflow.session import ship_package
from tripflow.sources import trips as trip_src


def batch_partition_writer(path: str, partition_by: tuple[str, ...] = (),
                           rebalanced: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append the micro-batch as Parquet under
    ``batch_id=<id>/``, replacing only that partition. ``rebalanced`` brings the
    rows of a partition together first (large ones stay cut), so that a batch
    leaves few files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if rebalanced:
            batch = batch.hint("rebalance", *map(F.col, partition_by))
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by, "batch_id")
            .parquet(path)
        )

    return write


def _start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
           processing_time: str | None, available_now: bool, name: str | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def start_status_stream(messages: DataFrame, out_path: str, checkpoint: str, unit: str = "s",
                        processing_time: str | None = "60 seconds", available_now: bool = False,
                        name: str | None = None) -> StreamingQuery:
    """Status messages (topic or files with a ``value`` column) parsed and
    appended to the status history (P-G: T1-T3, T6 via ``awaitTermination``).
    Messages without a station or a time (malformed, null, wrong types) go to
    ``<out_path>_quarantine`` with their raw text."""
    parsed = feeds.parse_status_messages(
        messages.withColumn("raw", F.col("value").cast("string")), unit=unit, keep=("raw",))
    parsed = parsed.withColumn("reason", feeds.status_defects())
    return _start(parsed, _split_writer(out_path, keep_in_good=("raw",)), checkpoint, processing_time,
                  available_now, name)


def _split_writer(out_path: str, keep_in_good: tuple[str, ...] = (),
                  publish: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing rows without ``reason`` to
    ``out_path`` and the others to ``<out_path>_quarantine``; ``publish`` gets
    the messages of all."""
    good_writer = batch_partition_writer(out_path)
    bad_writer = batch_partition_writer(out_path.rstrip("/") + "_quarantine")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good_writer(batch.filter(F.col("reason").isNull()).drop("reason", *keep_in_good), batch_id)
        bad_writer(batch.filter(F.col("reason").isNotNull()), batch_id)
        if publish:
            publish(feeds.to_station_messages(batch), batch_id)
        batch.unpersist()

    return sink


def start_feed_history(snapshots: DataFrame, out_path: str, checkpoint: str,
                       processing_time: str | None = "60 seconds", available_now: bool = False,
                       name: str | None = None,
                       publish: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Landed status-feed snapshots exploded to one row per station and
    appended to the history (P-C, K7, T4). Rows that cannot be stored go to
    ``<out_path>_quarantine``. ``publish`` takes the batch's station objects as
    topic messages (K3) and the batch id; a replayed batch is published again."""
    rows = feeds.status_rows(feeds.station_objects(snapshots, keep=("snapshot_time",)),
                             keep=("snapshot_time", "station"))
    rows = rows.withColumn("inserted_at", F.coalesce("snapshot_time", "inserted_at")).drop("snapshot_time")
    rows = rows.withColumn("reason", feeds.status_defects())
    return _start(rows, _split_writer(out_path, ("station",), publish), checkpoint, processing_time, available_now, name)


def start_incremental_trip_load(spark: SparkSession, cleaned_dir: str, table_path: str,
                                checkpoint: str, available_now: bool = True,
                                name: str | None = None, files_per_batch: int = 200) -> StreamingQuery:
    """Every new cleaned Parquet file loaded once into the trip table (P-B, T5),
    which is laid out by month and batch.

    A file that is not Parquet, lacks a column of the table or has one of
    another type is recorded in ``<table_path>_failed`` and the others go on
    (V1, V6). Rows without a ride_id, with a text over its limit (V4), whose
    ride_id is already in the table or repeated in the batch (K9) are written
    to ``<table_path>_rejected`` with the reason and the source file, so
    nothing is silently lost. The file source's checkpoint is the record of
    loaded files (V7). ``files_per_batch`` bounds a micro-batch, and with it
    the file names that the driver handles (cleaned files hold at most 200,000
    rows); the table's keys are read once for each.
    """
    writer = batch_partition_writer(table_path, ("month",), rebalanced=True)
    rejected = batch_partition_writer(table_path.rstrip("/") + "_rejected", rebalanced=True)
    failed = batch_partition_writer(table_path.rstrip("/") + "_failed")
    lineage = ["source_file", "source_row"]
    defects = quality.reason_column(
        [("null_ride_id", F.col("ride_id").isNull())]
        + [(f"long_{c}", F.length(c) > n) for c, n in schemas.TRIP_TEXT_LIMITS.items()])

    def sink(files: DataFrame, batch_id: int) -> None:
        checked = files.mapInArrow(trip_src.check_cleaned, "path string, error string").collect()
        bad = [(r.path.rsplit("/", 1)[-1], r.error) for r in checked if r.error]
        if bad:
            failed(spark.createDataFrame(bad, "file_name string, error_message string")
                   .withColumn("failed_at", tf.now()), batch_id)
        good = [r.path for r in checked if not r.error]
        if good:
            load(trip_src.read_cleaned_files(spark, cleaned_dir, good), batch_id)

    def load(batch: DataFrame, batch_id: int) -> None:
        try:
            # a replayed batch must not see its own earlier output
            target = (spark.read.schema("ride_id string, month date, batch_id long").parquet(table_path)
                      .filter(F.col("batch_id") != batch_id).select("ride_id"))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            target = spark.createDataFrame([], "ride_id string")
        # one pass flags every row; both tables are written from it
        flagged = tables.flag_new(batch.withColumn("reason", defects), target, ["ride_id"], ["started_at", *lineage],
                                  F.col("reason").isNull()).persist()
        writer(flagged.filter("is_new").select(*schemas.TRIP_COLUMNS), batch_id)
        lost = flagged.filter(~F.col("is_new")).drop("is_new")
        rejected(lost.withColumn("reason", F.coalesce("reason", F.lit("duplicate_ride_id"))), batch_id)
        flagged.unpersist()

    ship_package(spark)
    files = trip_src.stream_cleaned_files(spark, cleaned_dir, files_per_batch)
    return _start(files, sink, checkpoint, None, available_now, name)


INFO_VALUES = [f.name for f in schemas.STATION_INFORMATION.fields
               if f.name not in ("station_id", "created_at", "updated_at")]


def upsert_info_batch(spark: SparkSession, snapshots: DataFrame, table_path: str, batch_id: int = 0) -> str | None:
    """Upsert one batch of metadata snapshots into the versioned station
    table and commit a new version (K8). Rows are stamped with their
    snapshot time, and the batch's latest snapshot time is the update time,
    so replaying a batch writes the same contents again. Elements without a
    station_id go to ``<table_path>_quarantine``, under the batch's id."""
    rows = feeds.info_rows(feeds.station_objects(snapshots, keep=("snapshot_time",)), keep=("snapshot_time",))
    rows = rows.withColumn("last_reported", F.coalesce("snapshot_time", "last_reported")).persist()
    keyless = F.col("station_id").isNull()
    batch_partition_writer(table_path.rstrip("/") + "_quarantine")(rows.filter(keyless), batch_id)
    every, rows = rows, rows.filter(~keyless)
    as_of = rows.agg(F.max("last_reported")).first()[0]
    if as_of is None:
        every.unpersist()
        return None
    existing = sinks.read_current(spark, table_path, schemas.STATION_INFORMATION)
    merged = tables.upsert(existing, rows, "station_id", INFO_VALUES, version="last_reported", as_of=as_of)
    out = sinks.commit_version(merged.select(*schemas.STATION_INFORMATION.fieldNames()), table_path)
    every.unpersist()
    return out


def start_info_upserts(spark: SparkSession, snapshots: DataFrame, table_path: str, checkpoint: str,
                       processing_time: str | None = "1 day", available_now: bool = False,
                       name: str | None = None) -> StreamingQuery:
    """Each new metadata snapshot file folded into the station table once
    (P-D: S4, K8, T4)."""
    return _start(snapshots, lambda batch, i: upsert_info_batch(spark, batch, table_path, i), checkpoint,
                  processing_time, available_now, name)
