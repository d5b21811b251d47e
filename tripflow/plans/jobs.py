"""Job entry points, one per data flow (P-A ... P-H).

Each job reads with :mod:`tripflow.sources`, transforms with
:mod:`tripflow.operators` and writes with :mod:`tripflow.sinks` or a
streaming query. Run one with ``spark-submit -m tripflow.plans.jobs <job> ...``
or call the function from a driver program.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripflow import schemas, sinks, streaming
from tripflow import functions as tf
from tripflow.operators import clean, enrich, metrics, stations
from tripflow.operators.joins import released_after
from tripflow.sources import feeds as feed_src
from tripflow.sources import relational, trips as trip_src
from tripflow.session import build_session, fresh_dir, ship_package


# -- P-A: archives -> cleaned Parquet by month + quarantine + manifest ----------

COUNTS_SCHEMA = "file_name string, rows long, kept long, quarantined long"


def clean_trip_archives(spark: SparkSession, archive_root: str, cleaned_path: str,
                        quarantine_path: str, manifest_path: str, spread: int | None = None,
                        as_of=None) -> DataFrame:
    """Expand every archive not processed before, clean it, and write kept
    rows by month, quarantined rows with their reason, and one manifest row
    per archive with rows read / kept / quarantined (A6, V5-V7). Counts and
    defects per month of the run (A3, A4) go to ``<manifest_path>_months``.

    The archives' directories are read first; then the entries are dealt to the
    tasks, which inflate and type each once, into a staged table below the shared
    folder. Every output is read from there, column by column, and it is removed
    at the end. A CSV that cannot be read to its end is recorded as failed and
    none of its rows is kept, the archive's other CSVs are. Returns the
    per-archive counts.
    """
    ship_package(spark)
    stage = fresh_dir(spark, "clean")
    listed = trip_src.list_archives(spark, archive_root).withColumn("file_name", tf.base_name("path"))
    done = relational.done_file_names(spark, manifest_path, manifest_path.rstrip("/") + "_failed")
    listed.join(done, "file_name", "left_anti").select("path", "file_name").write.parquet(f"{stage}/archives")
    new = spark.read.parquet(f"{stage}/archives")
    if new.isEmpty():
        sinks.remove(spark, stage)
        return spark.createDataFrame([], COUNTS_SCHEMA)
    keep = ("source", "entry", "error")
    trip_src.archive_entries(new).write.parquet(f"{stage}/entries")
    entries = spark.read.schema(trip_src.ENTRY_SCHEMA).parquet(f"{stage}/entries")
    records = trip_src.entry_records(entries, trip_src.entry_tasks(entries), spread)
    typed = clean.with_reason(clean.type_trips(clean.bind_by_header(records, keep=keep), keep=keep))
    typed.withColumn("archive", tf.base_name("source")).write.parquet(f"{stage}/typed")
    typed = spark.read.parquet(f"{stage}/typed")
    typed.filter(F.col("error").isNotNull()).select("archive", *keep).write.parquet(f"{stage}/failed")
    failed = spark.read.parquet(f"{stage}/failed")
    rows = trip_src.whole_entries(typed, failed)
    # outputs are partitioned by archive and replace that archive's earlier
    # output, so re-running after a failure before the manifest write is safe
    good = rows.filter(F.col("reason").isNull()).select(*schemas.TRIP_COLUMNS, "archive")
    sinks.write_by_month(good, cleaned_path, source_col="archive")
    (rows.filter(F.col("reason").isNotNull()).drop("error")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archive")
     .parquet(quarantine_path))
    metrics.defects_per_month(rows).write.mode("append").parquet(manifest_path.rstrip("/") + "_months")
    per_file = rows.groupBy(F.col("archive").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("reason").isNull()).alias("kept"),
        F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
    )
    no_archive = failed.filter(F.col("entry").isNull()).select(F.col("archive").alias("file_name"))
    # every new archive gets a row, an empty one with zeros, so it is not read again (V5, V7)
    counts = (
        new.select("file_name").join(no_archive, "file_name", "left_anti")
        .join(per_file, "file_name", "left")
        .fillna(0, ["rows", "kept", "quarantined"])
    )
    stamp = tf.now(as_of)
    run_counts = f"{manifest_path.rstrip('/')}_counts/{stage.rsplit('/', 1)[-1]}"
    counts.write.parquet(run_counts)
    counts = spark.read.schema(COUNTS_SCHEMA).parquet(run_counts)
    failed.select(F.concat_ws("!", "archive", "entry").alias("file_name"),
                  F.col("error").alias("error_message"), stamp.alias("failed_at")) \
        .write.mode("append").parquet(manifest_path.rstrip("/") + "_failed")
    counts.select("file_name", stamp.alias("ingested_at")).write.mode("append").parquet(manifest_path)
    sinks.remove(spark, stage)
    return counts


# -- P-B: cleaned Parquet -> trip table, each file once -------------------------

def load_trips(spark: SparkSession, cleaned_path: str, table_path: str, checkpoint: str,
               table: str | None = None):
    """Incremental, repeat-safe load of new cleaned files (T5, K9). ``table``
    declares it in the catalog with its schema before the load (K10)."""
    if table:
        sinks.ensure_table(spark, table, StructType(
            [*schemas.TRIP.fields, StructField("batch_id", LongType())]), table_path, ["month", "batch_id"])
    q = streaming.start_incremental_trip_load(spark, cleaned_path, table_path, checkpoint, available_now=True)
    q.awaitTermination()
    if table:
        spark.catalog.recoverPartitions(table)
    return spark.read.schema(schemas.TRIP).parquet(table_path)


# -- P-C / P-D: feeds ------------------------------------------------------------

def store_status_feed(spark: SparkSession, landing: str, history_path: str, checkpoint: str,
                      available_now: bool = True, servers: str | None = None, topic: str | None = None):
    """Landed status snapshots appended to the status history and, with a
    topic, published to it as whole station objects (P-C, K3)."""
    publish = (lambda messages, _: sinks.publish(messages, servers, topic)) if topic else None
    q = streaming.start_feed_history(feed_src.stream_snapshots(spark, landing), history_path, checkpoint,
                                     available_now=available_now, publish=publish)
    if available_now:
        q.awaitTermination()
    return q


def upsert_station_information(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                               available_now: bool = True):
    """Fold each new landed metadata snapshot into the station table and
    commit a new version (P-D, K8). A key repeated across snapshots takes the
    latest; each snapshot file is processed once (the stream's checkpoint)."""
    q = streaming.start_info_upserts(spark, feed_src.stream_snapshots(spark, landing), table_path, checkpoint,
                                     available_now=available_now)
    if available_now:
        q.awaitTermination()
    return q


# -- P-E / P-F / P-H: batch transforms ----------------------------------------------

def status_run_id(status: DataFrame) -> str:
    """Run id of a status history: the time of its latest report."""
    return status.agg(F.date_format(F.max("last_reported"), "yyyyMMddHHmmss")).first()[0] or "none"


def transform_stations(spark: SparkSession, status: DataFrame, info: DataFrame, out_path: str,
                       run_id: str | None = None) -> int:
    """Station aggregate of one run added to the history in ``out_path`` (K11),
    in folders of its own by run and aggregation_date: a run never touches the
    rows of another, and the same run again replaces its own. ``run_id``
    defaults to the time of the latest status. Returns the run's row count
    through a temp view and SQL, as the verification step (A2)."""
    run_id = run_id or status_run_id(status)
    agg = stations.station_aggregate(status, info).withColumn("run_id", F.lit(run_id))
    sinks.write_run(agg, out_path, "run_id", run_id, ["aggregation_date"])
    written = spark.read.parquet(f"{out_path.rstrip('/')}/run_id={run_id}")
    return metrics.total_records(spark, written, "station_status_transformed").first().total_records


def enrich_trip_table(spark: SparkSession, trips: DataFrame, transformed: DataFrame, out_path: str,
                      latest: bool = True) -> None:
    """Trips with start and end station columns, written by month (P-F).
    ``latest`` first reduces the growing station table to one row per
    ``short_name``, the key of the join (D1), which bounds the broadcast side
    and keeps one row per trip even where stations share a short name."""
    st = stations.latest_per_station(transformed, key="short_name") if latest else transformed
    with released_after():
        sinks.write_by_month(enrich.enrich_trips(trips, st), out_path, mode="overwrite")


def renting_status(spark: SparkSession, status: DataFrame, out_path: str) -> None:
    """Status rows of renting stations into their own table, by day (P-H, D9)."""
    out = stations.renting_only(status).withColumn("day", tf.to_day("last_reported"))
    sinks.write_partitioned(out, out_path, ["day"])


# -- P-G: status topic -> history ---------------------------------------------------

def stream_status_topic(spark: SparkSession, servers: str, topic: str, out_path: str, checkpoint: str,
                        unit: str = "s", processing_time: str = "60 seconds"):
    """Topic messages parsed and appended every minute until stopped (P-G)."""
    from tripflow.sources.topic import read_topic

    q = streaming.start_status_stream(read_topic(spark, servers, topic), out_path, checkpoint, unit=unit,
                                      processing_time=processing_time)
    q.awaitTermination()


# -- tables by place: a Parquet folder, or a relational table as ``jdbc:...#table`` --

def read_place(spark: SparkSession, place: str, schema: StructType) -> DataFrame:
    """The declared columns of the table at ``place``."""
    if place.startswith("jdbc:"):
        url, _, table = place.partition("#")
        return schemas.conform(relational.read_table(spark, url, table), schema, strict=True)
    return spark.read.schema(schema).parquet(place)


def append_place(df: DataFrame, place: str) -> None:
    """Rows added to a relational table (K1, K6)."""
    url, _, table = place.partition("#")
    sinks.write_jdbc(df, url, table)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tripflow.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("clean")
    a.add_argument("archives"), a.add_argument("cleaned"), a.add_argument("quarantine"), a.add_argument("manifest")
    b = sub.add_parser("load")
    b.add_argument("cleaned"), b.add_argument("table"), b.add_argument("checkpoint"), b.add_argument("--name")
    c = sub.add_parser("status-feed")
    c.add_argument("landing"), c.add_argument("history"), c.add_argument("checkpoint")
    c.add_argument("--servers"), c.add_argument("--topic")
    d = sub.add_parser("info-feed")
    d.add_argument("landing"), d.add_argument("table"), d.add_argument("checkpoint")
    e = sub.add_parser("stations")
    e.add_argument("history"), e.add_argument("info_table"), e.add_argument("out"), e.add_argument("--append-to")
    f = sub.add_parser("enrich")
    f.add_argument("trips"), f.add_argument("transformed"), f.add_argument("out"), f.add_argument("--append-to")
    g = sub.add_parser("stream")
    g.add_argument("servers"), g.add_argument("topic"), g.add_argument("out"), g.add_argument("checkpoint")
    h = sub.add_parser("renting")
    h.add_argument("history"), h.add_argument("out")
    args = p.parse_args(argv)
    spark = build_session(f"tripflow-{args.job}")
    if args.job == "clean":
        clean_trip_archives(spark, args.archives, args.cleaned, args.quarantine, args.manifest).show()
    elif args.job == "load":
        load_trips(spark, args.cleaned, args.table, args.checkpoint, args.name)
    elif args.job == "status-feed":
        store_status_feed(spark, args.landing, args.history, args.checkpoint,
                          servers=args.servers, topic=args.topic)
    elif args.job == "info-feed":
        upsert_station_information(spark, args.landing, args.table, args.checkpoint)
    elif args.job == "stations":
        status = read_place(spark, args.history, schemas.STATION_STATUS)
        info = (read_place if args.info_table.startswith("jdbc:") else sinks.read_current)(
            spark, args.info_table, schemas.STATION_INFORMATION)
        run_id = status_run_id(status)
        print(transform_stations(spark, status, info, args.out, run_id))
        if args.append_to:
            run = spark.read.schema(schemas.STATION_STATUS_TRANSFORMED).parquet(f"{args.out.rstrip('/')}/run_id={run_id}")
            append_place(run, args.append_to)
    elif args.job == "enrich":
        trips = read_place(spark, args.trips, schemas.TRIP)
        st = read_place(spark, args.transformed, schemas.STATION_STATUS_TRANSFORMED)
        enrich_trip_table(spark, trips, st, args.out)
        if args.append_to:
            append_place(spark.read.parquet(args.out), args.append_to)
    elif args.job == "stream":
        stream_status_topic(spark, args.servers, args.topic, args.out, args.checkpoint)
    elif args.job == "renting":
        renting_status(spark, read_place(spark, args.history, schemas.STATION_STATUS), args.out)


if __name__ == "__main__":
    main()
