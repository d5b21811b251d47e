"""
equivalent SQL for the DuckDB oracle.

Each query maps a driver table onto the bike-share shape
(:mod:`tripflow.plans.standins`) and runs the library operator on it over
the whole table. Column names are aliased identically on both sides.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable

# the package sits next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import functions as tf
from tripflow import schemas, sinks, streaming
from tripflow.operators import clean, enrich, feeds, manifest, metrics, quality, stations, tables
from tripflow.plans import increments, jobs
from tripflow.plans import oracle as O
from tripflow.plans import standins as S
from tripflow.sinks import compaction
from tripflow.session import ensure_job_conf, fresh_dir, ship_package
from tripflow.sources import feeds as feed_src
from tripflow.sources import relational
from tripflow.sources import trips as trip_src
from tripflow.sources.trips import file_of

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_job_conf(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run

    return deco


# ---------------------------------------------------------------------------
# P-E station transform

def _station_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.station_aggregate(S.status(spark, sf_dir), S.info(spark, sf_dir))


@_register("station_aggregate", O.with_(status=O.STATUS, info=O.INFO) + O.STATION_AGG)
def q_station_aggregate(spark, sf_dir):
    """Status ⋈ metadata, 12-key aggregate, aggregation date."""
    return _station_agg(spark, sf_dir)


@_register("station_aggregate_incremental", O.with_(status=O.STATUS, info=O.INFO) + O.STATION_AGG)
def q_station_aggregate_incremental(spark, sf_dir):
    """The station aggregate of a history that grows by four batches, each with
    reports of all days, from daily states that are kept from run to run: as
    ``station_aggregate`` (A1 J1 F7 K11)."""
    run = fresh_dir(spark, "station_increments")
    status, append = S.status(spark, sf_dir), streaming.batch_partition_writer(f"{run}/history")
    for batch in range(4):
        append(status.filter(F.pmod(F.xxhash64("station_id", "last_reported"), F.lit(4)) == batch), batch)
        increments.update_states(spark, f"{run}/history", f"{run}/states")
    return increments.station_aggregate_incremental(spark, f"{run}/history", f"{run}/states", S.info(spark, sf_dir))


@_register("station_latest", O.with_(status=O.STATUS, info=O.INFO, agg=O.STATION_AGG) + O.STATION_LATEST)
def q_station_latest(spark, sf_dir):
    """Latest aggregate row per station."""
    return stations.latest_per_station(_station_agg(spark, sf_dir))


@_register("row_count", O.with_(status=O.STATUS, info=O.INFO, agg=O.STATION_AGG)
           + " SELECT COUNT(*) AS total_records FROM agg")
def q_row_count(spark, sf_dir):
    """Temp view + SQL count over the aggregate (A2 Q1 Q2)."""
    return metrics.total_records(spark, _station_agg(spark, sf_dir), "station_status_transformed")


@_register("renting_only", O.with_(status=O.STATUS)
           + " SELECT station_id, num_bikes_available, num_docks_available, is_installed,"
             " is_renting, is_returning, last_reported FROM status WHERE is_renting")
def q_renting_only(spark, sf_dir):
    """Status rows of renting stations, arrival time dropped."""
    return stations.renting_only(S.status(spark, sf_dir), drop=("inserted_at",))


# ---------------------------------------------------------------------------
# P-F trip enrichment

def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The station table as the station job leaves it: written, so that its
    size in bytes is known where it is joined."""
    out = fresh_dir(spark, "station_table")
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)


@_register("trip_enrich", O.with_(status=O.STATUS, info=O.INFO, agg=O.STATION_AGG, trips=O.TRIPS)
           + O.enrich_select("agg"))
def q_trip_enrich(spark, sf_dir):
    """Trips ⟕ aggregate on start and end short_name; multiplicity kept."""
    return enrich.enrich_trips(S.trips(spark, sf_dir, spread=True), _written(spark, _station_agg(spark, sf_dir)))


@_register("trip_enrich_latest",
           O.with_(status=O.STATUS, info=O.INFO, agg=O.STATION_AGG, latest=O.STATION_LATEST,
                   trips=O.TRIPS) + O.enrich_select("latest"))
def q_trip_enrich_latest(spark, sf_dir):
    """Trips ⟕ latest row per station, both ends: one row per trip."""
    latest = _written(spark, stations.latest_per_station(_station_agg(spark, sf_dir)))
    return enrich.enrich_trips(S.trips(spark, sf_dir, spread=True), latest)


@_register("trip_enrich_shared_short_name",
           O.with_(status=O.STATUS, trips=O.TRIPS)
           + ", last AS (SELECT CAST(user_id - user_id % 2 AS VARCHAR) || '.10' AS short_name, max(ts) AS reported"
             " FROM events JOIN customer ON user_id = c_custkey GROUP BY 1)"
             " SELECT t.ride_id, t.month, s.short_name AS start_station_short_name,"
             " s.reported AS start_status_last_reported, e.reported AS end_status_last_reported"
             " FROM trips t LEFT JOIN last s ON t.start_station_id = s.short_name"
             " LEFT JOIN last e ON t.end_station_id = e.short_name")
def q_trip_enrich_shared_short_name(spark, sf_dir):
    """The enrichment job (P-F) where every two stations share a short name:
    one row per trip, with the latest report of either (D1 J2 J3 K1)."""
    out = fresh_dir(spark, "shared_short_name")
    pair = F.col("station_id").cast("long")
    info = S.info(spark, sf_dir).withColumn(
        "short_name", F.concat((pair - pair % 2).cast("string"), F.lit(S.SHORT_NAME_SUFFIX)))
    agg = _written(spark, stations.station_aggregate(S.status(spark, sf_dir), info))
    jobs.enrich_trip_table(spark, S.trips(spark, sf_dir), agg, out)
    return spark.read.parquet(out).select("ride_id", "month", "start_station_short_name",
                                          "start_status_last_reported", "end_status_last_reported")


# ---------------------------------------------------------------------------
# trip metrics and checks

@_register("trips_per_month", O.with_(trips=O.TRIPS)
           + " SELECT month, COUNT(*) AS trip_count FROM trips GROUP BY month")
def q_trips_per_month(spark, sf_dir):
    """Trips per month (F8 A3)."""
    return metrics.trips_per_month(S.trips(spark, sf_dir))


@_register("trips_per_day",
           " SELECT CAST(o_orderdate AS DATE) AS day, COUNT(DISTINCT o_orderkey) AS trip_count"
           " FROM orders GROUP BY 1")
def q_trips_per_day(spark, sf_dir):
    """Distinct rides per day, orders as rides."""
    orders = S.table(spark, sf_dir, "orders")
    return metrics.trips_per_day(orders, started_at="o_orderdate", ride_id="o_orderkey")


@_register("duplicate_keys", O.with_(trips=O.TRIPS)
           + " SELECT ride_id, COUNT(*) AS occurrences FROM trips GROUP BY ride_id HAVING COUNT(*) > 1")
def q_duplicate_keys(spark, sf_dir):
    """ride_id values that occur more than once (V3)."""
    return quality.duplicate_keys(S.trips(spark, sf_dir), ["ride_id"])


@_register("length_check",
           " SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents WHERE length(text) > 255")
def q_length_check(spark, sf_dir):
    """Texts longer than the 255-character column limit (V4)."""
    docs = S.table(spark, sf_dir, "documents")
    return quality.length_violations(docs, {"text": 255}, "doc_id")


# ---------------------------------------------------------------------------
# scalar functions

@_register("to_decimal",
           " SELECT c_custkey, TRY_CAST(c_acctbal / 7 AS DECIMAL(9,6)) AS acctbal_dec,"
           " TRY_CAST(c_acctbal AS DECIMAL(9,6)) AS acctbal_fit FROM customer")
def q_to_decimal(spark, sf_dir):
    """Numbers to decimal(9,6); out of range gives null."""
    c = S.table(spark, sf_dir, "customer")
    return c.select("c_custkey", tf.to_decimal(F.col("c_acctbal") / 7).alias("acctbal_dec"),
                    tf.to_decimal("c_acctbal").alias("acctbal_fit"))


@_register("epoch_times",
           " SELECT event_id, epoch_us(ts) // 1000000 AS epoch_s,"
           " date_trunc('second', ts) AS ts_s, epoch_us(ts) // 1000 AS epoch_ms,"
           " date_trunc('millisecond', ts) AS ts_ms FROM events")
def q_epoch_times(spark, sf_dir):
    """Timestamps to epoch seconds / millis and back."""
    ev = S.table(spark, sf_dir, "events")
    s = tf.timestamp_to_epoch("ts", "s")
    ms = tf.timestamp_to_epoch("ts", "ms")
    return ev.select("event_id", s.alias("epoch_s"), tf.epoch_to_timestamp(s, "s").alias("ts_s"),
                     ms.alias("epoch_ms"), tf.epoch_to_timestamp(ms, "ms").alias("ts_ms"))


@_register("epoch_text", " SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS reported FROM events")
def q_epoch_text(spark, sf_dir):
    """Epoch seconds to text."""
    seconds = tf.timestamp_to_epoch("ts", "s")
    return S.table(spark, sf_dir, "events").select("event_id", tf.epoch_to_text(seconds).alias("reported"))


# ---------------------------------------------------------------------------
# manifests and table writes

_FILES_SQL = """
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.parquet' AS file_name, n_chars FROM documents"""


@_register("new_files",
           O.with_(files=_FILES_SQL)
           + " SELECT f.file_name, f.n_chars FROM files f WHERE f.file_name NOT IN ("
             " SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.parquet' FROM labels"
             " WHERE quality = 1 OR toxic = 1)")
def q_new_files(spark, sf_dir):
    """Files neither loaded (quality=1) nor failed (toxic=1) yet."""
    def name(c):
        return F.concat(F.lit("doc-"), F.col(c).cast("string"), F.lit(".parquet")).alias("file_name")

    files = S.table(spark, sf_dir, "documents").select(name("doc_id"), "n_chars")
    labels = S.table(spark, sf_dir, "labels")
    loaded = labels.filter(F.col("quality") == 1).select(name("doc_id"))
    failed = labels.filter(F.col("toxic") == 1).select(name("doc_id"))
    return manifest.unprocessed(files, loaded, failed)


# ---------------------------------------------------------------------------
# keyed writes

# Fixed values of the upsert scenario: two feed snapshots, then the run time.
UPSERT_T1, UPSERT_T2, UPSERT_AS_OF = "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-03-02 00:00:00"
_INFO_VALUES = ["name", "short_name", "lat", "lon", "region_id", "capacity",
                "eightd_has_key_dispenser", "has_kiosk", "installed", "last_reported"]


@_register("station_upsert",
           O.with_(info=O.INFO)
           + " SELECT station_id, name, short_name, lat, lon, region_id,"
             " CASE region_id WHEN 'HOUSEHOLD' THEN capacity + 1 WHEN 'MACHINERY' THEN capacity + 2"
             " ELSE capacity END AS capacity, eightd_has_key_dispenser, has_kiosk, installed,"
             f" CASE region_id WHEN 'HOUSEHOLD' THEN TIMESTAMP '{UPSERT_T1}'"
             f" WHEN 'MACHINERY' THEN TIMESTAMP '{UPSERT_T2}' ELSE last_reported END AS last_reported,"
             f" CASE WHEN region_id = 'HOUSEHOLD' THEN TIMESTAMP '{UPSERT_AS_OF}' ELSE created_at END AS created_at,"
             f" CASE WHEN region_id IN ('HOUSEHOLD', 'MACHINERY') THEN TIMESTAMP '{UPSERT_AS_OF}'"
             " ELSE updated_at END AS updated_at FROM info")
def q_station_upsert(spark, sf_dir):
    """Metadata table upserted with two feed snapshots (K8): HOUSEHOLD
    stations are new, MACHINERY ones change twice (the later wins), the rest
    are untouched."""
    info = S.info(spark, sf_dir)
    existing = info.filter(F.col("region_id") != "HOUSEHOLD")
    feed = info.filter(F.col("region_id").isin("HOUSEHOLD", "MACHINERY"))
    snap1 = feed.withColumn("capacity", F.col("capacity") + 1) \
        .withColumn("last_reported", tf.now(UPSERT_T1))
    snap2 = feed.filter(F.col("region_id") == "MACHINERY") \
        .withColumn("capacity", F.col("capacity") + 2) \
        .withColumn("last_reported", tf.now(UPSERT_T2))
    updates = snap1.unionByName(snap2).withColumn("version", F.col("last_reported"))
    out = tables.upsert(existing, updates, "station_id", _INFO_VALUES, version="version",
                        as_of=UPSERT_AS_OF)
    return out.select(*schemas.STATION_INFORMATION.fieldNames())


_LOADED_BEFORE = "1998-01-01 00:00:00"
_TRIP_ORDER = [c for c in schemas.TRIP_COLUMNS if c not in ("ride_id", "started_at")]


@_register("insert_if_absent",
           O.with_(trips=O.TRIPS,
                   ranked="SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at NULLS FIRST, "
                          + ", ".join(f"{c} NULLS FIRST" for c in _TRIP_ORDER) + ") AS rn FROM trips")
           + f" SELECT {', '.join(schemas.TRIP_COLUMNS)} FROM ranked WHERE rn = 1 AND ride_id NOT IN"
             f" (SELECT ride_id FROM trips WHERE started_at < TIMESTAMP '{_LOADED_BEFORE}')")
def q_insert_if_absent(spark, sf_dir):
    """A full reload of the trips into a table that already holds the trips
    started before 1998: one row per new ride_id, earliest start wins (K9)."""
    trips = S.trips(spark, sf_dir, spread=True)
    target = tables.first_per_key(trips.filter(F.col("started_at") < tf.now(_LOADED_BEFORE)),
                                  ["ride_id"], ["started_at"])
    return tables.insert_if_absent(trips, target, ["ride_id"], ["started_at"])


# ---------------------------------------------------------------------------
# feeds and messages

@_register("status_parse",
           O.with_(status=O.STATUS)
           + " SELECT station_id, num_bikes_available, num_docks_available,"
             " date_trunc('second', last_reported) AS last_reported FROM status")
def q_status_parse(spark, sf_dir):
    """Status rows published as JSON messages (K3) and parsed back."""
    msgs = feeds.to_status_messages(S.status(spark, sf_dir, spread=True))
    return feeds.parse_status_messages(msgs)


@_register("feed_explode",
           " SELECT CAST(floor(event_id / 100) AS BIGINT) AS snapshot_id,"
           " CAST(user_id AS VARCHAR) AS station_id,"
           " CAST(floor(value) AS INTEGER) AS num_bikes_available,"
           " CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_docks_available,"
           " TRUE AS is_installed, event_type <> 'error' AS is_renting,"
           " event_type NOT IN ('view', 'purchase') AS is_returning,"
           " date_trunc('second', ts) AS last_reported FROM events")
def q_feed_explode(spark, sf_dir):
    """Status feed documents exploded to one row per station."""
    docs = S.status_feed_docs(S.table(spark, sf_dir, "events"))
    rows = feeds.status_rows(feeds.station_objects(docs, keep=("snapshot_id",)), keep=("snapshot_id",))
    return rows.drop("inserted_at")


@_register("absent_vs_null",
           " SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS name,"
           " CASE c_mktsegment WHEN 'AUTOMOBILE' THEN FALSE WHEN 'BUILDING' THEN NULL"
           " ELSE c_acctbal >= 0 END AS has_kiosk,"
           " FALSE AS eightd_has_key_dispenser, TRUE AS installed,"
           " CAST(c_nationkey AS INTEGER) AS capacity FROM customer")
def q_absent_vs_null(spark, sf_dir):
    """Metadata feed: a flag absent from an element defaults to false, an
    explicit null stays null (F12)."""
    docs = S.info_feed_docs(S.table(spark, sf_dir, "customer"))
    rows = feeds.info_rows(feeds.station_objects(docs), as_of=UPSERT_T1)
    return rows.select("station_id", "name", "has_kiosk", "eightd_has_key_dispenser",
                       "installed", "capacity")


# ---------------------------------------------------------------------------
# trip cleaning

_RAW = """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ride_id,
         CASE WHEN year(l_shipdate) = 2001 THEN 'unknown'
              WHEN l_returnflag = 'A' THEN 'classic_bike' WHEN l_returnflag = 'N' THEN 'electric_bike'
              ELSE 'docked_bike' END AS rideable_type,
         CASE WHEN l_discount = 0.1 THEN NULL ELSE l_shipdate END AS started_at,
         l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) AS ended_at,
         'Station ' || CAST(l_suppkey AS VARCHAR) || ', Pier' AS start_station_name,
         CAST(l_suppkey AS VARCHAR) || '.10' AS start_station_id,
         'Station ' || CAST(l_partkey AS VARCHAR) AS end_station_name,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) || '.10' END AS end_station_id,
         TRY_CAST(l_extendedprice / 100 AS DECIMAL(9,6)) AS start_lat,
         TRY_CAST(-l_discount AS DECIMAL(9,6)) AS start_lng,
         TRY_CAST(l_tax AS DECIMAL(9,6)) AS end_lat,
         TRY_CAST(l_quantity AS DECIMAL(9,6)) AS end_lng,
         CASE WHEN l_linestatus = 'O' THEN 'member' ELSE 'casual' END AS member_casual,
         CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(date_trunc('month', l_shipdate) AS DATE) END AS month
  FROM lineitem"""
_REASON = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 'null_{c}' END" for c in schemas.TRIP_COLUMNS) + ")"


def _typed_raw(spark, sf_dir, columns=schemas.TRIP_CSV_COLUMNS):
    records = S.raw_trip_records(S.table(spark, sf_dir, "lineitem", spread=True))
    return clean.type_trips(clean.bind_by_header(records, columns), columns=columns)


@_register("trip_clean",
           O.with_(raw=_RAW) + f" SELECT * FROM raw WHERE {_REASON} = ''")
def q_trip_clean(spark, sf_dir):
    """Trip CSV records bound by header name, typed, rows with nulls removed
    (S5 D6 P9-P13 F8-F10 F14)."""
    kept, _ = clean.split_clean(_typed_raw(spark, sf_dir))
    return kept


@_register("trip_clean_csv_files",
           O.with_(raw=_RAW) + f" SELECT * FROM raw WHERE {_REASON} = ''")
def q_trip_clean_csv_files(spark, sf_dir):
    """The trip CSV records landed as text files, each with its header as the
    first line (S5), read back with that header, then cleaned as in
    ``trip_clean``. A source is landed as several files, so that a month with
    most of the trips is not one task."""
    kept, _ = clean.clean_trips(_landed_csv(spark, sf_dir))
    return kept


def _landed_csv(spark, sf_dir, **layout):
    landing = fresh_dir(spark, "trip_csv")
    S.land_csv_files(S.table(spark, sf_dir, "lineitem"), landing, **layout)
    return trip_src.csv_records(spark, landing, glob="*.txt*", cut=True)


_MULTILINE = ', "Old"\n\r\n,Pier'  # a name with a comma, quotes, a blank line and line breaks


@_register("trip_csv_multiline",
           O.with_(raw=_RAW) + " SELECT * REPLACE (replace(start_station_name, ', Pier', ', \"Old\"' || chr(10) || chr(13)"
                               f" || chr(10) || ',Pier') AS start_station_name) FROM raw WHERE {_REASON} = ''")
def q_trip_csv_multiline(spark, sf_dir):
    """CSV files of a year whose start station names hold commas, quotes and
    line breaks, read in 50 splits or more, about two a file, that fall inside
    quotes too (S5 P9-P11): the same trips as in ``trip_clean``, none
    quarantined for its line breaks."""
    landing = fresh_dir(spark, "trip_csv")
    S.land_csv_files(S.table(spark, sf_dir, "lineitem"), landing, yearly=True, pier=_MULTILINE)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pieces = max(50, 2 * sinks.folder_files(spark, landing))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(sinks.folder_bytes(spark, landing) // pieces + 1))
        kept, _ = clean.clean_trips(trip_src.csv_records(spark, landing, glob="*.txt", cut=True))
        return _written(spark, kept)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


@_register("trip_clean_wide", O.with_(raw=_RAW) + f" SELECT * FROM raw WHERE {_REASON} = ''")
def q_trip_clean_wide(spark, sf_dir):
    """CSV files of 25 columns and more, whose 12 extra columns hold commas and
    quotes and stand elsewhere from month to month: the same trips as in
    ``trip_clean`` (S5 D6 P10). The files are compressed, as their text is many
    times the table."""
    kept, _ = clean.clean_trips(_landed_csv(spark, sf_dir, extra=12, compression="gzip"))
    return kept


@_register("trip_clean_no_ride_id",
           O.with_(raw=_RAW) + f" SELECT * REPLACE ('unknown' AS ride_id) FROM raw WHERE {_REASON} = ''")
def q_trip_clean_no_ride_id(spark, sf_dir):
    """CSV files without a ride_id column: no trip is lost, the id is the
    default text (S5 P13)."""
    kept, _ = clean.clean_trips(_landed_csv(spark, sf_dir, without=("ride_id",)))
    return kept


def _clean_job(spark, sf_dir):
    """Archives of the trip records, taken through the clean job (P-A)."""
    run = fresh_dir(spark, "trip_archives")
    S.land_archives(S.table(spark, sf_dir, "lineitem", spread=True), f"{run}/landing")
    jobs.clean_trip_archives(spark, f"{run}/landing", f"{run}/cleaned", f"{run}/quarantine", f"{run}/manifest")
    return run


@_register("trip_archive_clean", O.with_(raw=_RAW) + f" SELECT * FROM raw WHERE {_REASON} = ''")
def q_trip_archive_clean(spark, sf_dir):
    """The trip CSV records landed as zip archives with nested ones in them,
    through the clean job; its cleaned table (P-A: S6 S7 U1 P9-P13 K4)."""
    run = _clean_job(spark, sf_dir)
    return spark.read.schema(schemas.TRIP).parquet(f"{run}/cleaned").select(*schemas.TRIP_COLUMNS)


@_register("trip_archive_counts",
           O.with_(raw=_RAW) + ", months AS (SELECT month, COUNT(*) AS rows FROM raw GROUP BY month)"
           f" SELECT SUM(CASE WHEN {_REASON} = '' THEN 1 ELSE 0 END)::BIGINT AS kept,"
           f" SUM(CASE WHEN {_REASON} <> '' THEN 1 ELSE 0 END)::BIGINT AS quarantined,"
           " COUNT(*) AS rows, (SELECT COUNT(*) FROM months) AS months, 0::BIGINT AS not_recorded FROM raw")
def q_trip_archive_counts(spark, sf_dir):
    """Counts of the clean job over its archives, months with counts of their
    own, and archives that its logs do not name (A6 A3 V5 V7 S9)."""
    run = _clean_job(spark, sf_dir)
    done = relational.done_file_names(spark, f"{run}/manifest", f"{run}/manifest_failed")
    archives = trip_src.list_archives(spark, f"{run}/landing").select(tf.base_name("path").alias("file_name"))
    left = archives.join(done, "file_name", "left_anti").agg(F.count(F.lit(1)).alias("not_recorded"))
    months = spark.read.parquet(f"{run}/manifest_months").agg(F.count(F.lit(1)).alias("months"))
    counts = spark.read.option("recursiveFileLookup", "true").parquet(f"{run}/manifest_counts")
    one = F.lit(1)
    return counts.agg(F.sum("rows").alias("rows"), F.sum("kept").alias("kept"),
                      F.sum("quarantined").alias("quarantined")).withColumn("_k", one) \
        .join(months.withColumn("_k", one), "_k").join(left.withColumn("_k", one), "_k").drop("_k")


@_register("archive_names",
           " SELECT doc_id, n_chars FROM documents WHERE source NOT LIKE '%1%' AND n_chars >= 1000")
def q_archive_names(spark, sf_dir):
    """Files that have an archive's name and size."""
    docs = S.table(spark, sf_dir, "documents")
    stamp = F.when(F.contains("source", F.lit("1")), F.lit("archive")).otherwise(F.lit("202401"))
    files = docs.select("doc_id", F.col("n_chars").alias("length"), F.concat(
        F.lit("s3://trips/"), stamp, F.lit("-demo-tripdata"),
        F.when(F.col("doc_id") % 2 == 0, ".csv").otherwise(""), F.lit(".zip")).alias("path"))
    return trip_src.selected(files, tf.TRIP_ARCHIVE_PATTERN, 1000).select("doc_id", F.col("length").alias("n_chars"))


_LOAD_ROWS = O.with_(
    trips=O.TRIPS,
    checked="SELECT CASE WHEN ride_id LIKE '%-7' THEN NULL ELSE ride_id END AS ride_id, started_at,"
            " CASE WHEN ride_id LIKE '%-7' THEN 'null_ride_id' WHEN ride_id LIKE '%-6' THEN 'long_rideable_type'"
            " WHEN row_number() OVER (PARTITION BY ride_id ORDER BY started_at) > 1 THEN 'duplicate_ride_id'"
            " ELSE 'loaded' END AS outcome FROM trips")


@_register("trip_load",
           _LOAD_ROWS + " SELECT outcome, ride_id, started_at FROM checked UNION ALL"
           " SELECT 'failed file', 'broken.parquet', NULL UNION ALL SELECT 'failed file', 'narrow.parquet', NULL")
def q_trip_load(spark, sf_dir):
    """The load job (P-B) in two runs over the trips, some without a ride_id
    and some with a text over its limit, beside a file that is not Parquet and
    one that lacks columns: every row's and file's outcome (T3 T5 K9 S8 V1 V4
    V6 V7)."""
    run = fresh_dir(spark, "trip_load")
    seventh = F.col("ride_id").endswith("-7")
    trips = S.trips(spark, sf_dir, spread=True).withColumns({
        "rideable_type": F.when(F.col("ride_id").endswith("-6"), F.repeat(F.lit("x"), F.lit(60)))
        .otherwise(F.col("rideable_type")),
        "ride_id": F.when(~seventh, F.col("ride_id"))})
    member = F.col("ride_id").like("%1-%")
    sinks.write_by_month(trips.filter(member), f"{run}/cleaned")
    trips.agg(F.max("ride_id").alias("ride_id"), F.max("started_at").alias("started_at")) \
        .write.parquet(f"{run}/narrow")
    _place(spark, f"{run}/narrow", f"{run}/cleaned/narrow.parquet")
    spark.createDataFrame([("not Parquet",)], "value string").coalesce(1).write.text(f"{run}/broken")
    _place(spark, f"{run}/broken", f"{run}/cleaned/broken.parquet")
    jobs.load_trips(spark, f"{run}/cleaned", f"{run}/table", f"{run}/checkpoint")
    sinks.write_by_month(trips.filter(F.coalesce(~member, F.lit(True))), f"{run}/cleaned")
    loaded = jobs.load_trips(spark, f"{run}/cleaned", f"{run}/table", f"{run}/checkpoint")
    rejected = spark.read.parquet(f"{run}/table_rejected")
    failed = spark.read.parquet(f"{run}/table_failed")
    return loaded.select(F.lit("loaded").alias("outcome"), "ride_id", "started_at") \
        .unionByName(rejected.select(F.col("reason").alias("outcome"), "ride_id", "started_at")) \
        .unionByName(failed.select(F.lit("failed file").alias("outcome"), F.col("file_name").alias("ride_id"),
                                   F.lit(None).cast("timestamp_ntz").alias("started_at")))


def _place(spark, folder, path):
    """The one file that a job wrote into ``folder``, at ``path``."""
    fs, root = file_of(folder)
    part = next(f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith("part-"))
    fs.move(part, file_of(path)[1])


@_register("month_files",
           O.with_(trips=O.TRIPS) + " SELECT month, COUNT(*) AS trips, 0::BIGINT AS larger_files,"
           " COUNT(*) AS source_rows FROM trips GROUP BY month")
def q_month_files(spark, sf_dir):
    """Trips written by month in files of at most 500 rows and read back with
    their lineage: files over the bound, distinct source rows (L2 K4 S8)."""
    out = fresh_dir(spark, "month_files")
    sinks.write_by_month(S.trips(spark, sf_dir), out, rows_per_file=500)
    per_file = metrics.rows_per_file(trip_src.read_cleaned(spark, out), "month")
    return per_file.groupBy("month").agg(F.sum("n").alias("trips"), F.count_if(F.col("n") > 500).alias("larger_files"),
                                         F.sum("places").alias("source_rows"))


@_register("trip_quarantine",
           O.with_(raw=_RAW) + f" SELECT ride_id, {_REASON} AS reason FROM raw WHERE {_REASON} <> ''")
def q_trip_quarantine(spark, sf_dir):
    """Rows removed by cleaning, with the names of their null columns (V6)."""
    _, bad = clean.split_clean(_typed_raw(spark, sf_dir))
    return bad.select("ride_id", "reason")


@_register("null_profile",
           O.with_(raw=_RAW) + " SELECT COUNT(*) AS rows, "
           + ", ".join(f"COUNT(*) - COUNT({c}) AS null_{c}" for c in schemas.TRIP_COLUMNS) + " FROM raw")
def q_null_profile(spark, sf_dir):
    """Null count of every trip column before rows are dropped (A5)."""
    return metrics.null_profile(_typed_raw(spark, sf_dir))


@_register("month_defects",
           O.with_(raw=_RAW) + " SELECT month, COUNT(*) AS rows,"
           " COUNT(*) FILTER (WHERE ride_id IS NULL) AS no_ride_id,"
           " COUNT(*) FILTER (WHERE started_at IS NULL OR ended_at IS NULL) AS no_start_or_end"
           " FROM raw GROUP BY month")
def q_month_defects(spark, sf_dir):
    """Rows, rows without ride_id, rows without start or end time, per month,
    before rows are dropped (A4)."""
    return metrics.defects_per_month(_typed_raw(spark, sf_dir, ["ride_id", "started_at", "ended_at"]))


# ---------------------------------------------------------------------------
# streaming and written tables (each call writes below the session's shared
# checkpoint folder, in a fresh run folder)

@_register("status_parse_stream",
           O.with_(status=O.STATUS)
           + " SELECT station_id, num_bikes_available, num_docks_available,"
             " date_trunc('second', last_reported) AS last_reported FROM status")
def q_status_parse_stream(spark, sf_dir):
    """Status messages landed as files, read by a file stream with an
    availableNow trigger, parsed (T1) and written by the batch_id-keyed
    foreachBatch sink (T2-T5); the written table is returned."""
    run = fresh_dir(spark, "status_stream")
    landing, out, ckpt = f"{run}/landing", f"{run}/history", f"{run}/checkpoint"
    msgs = feeds.to_status_messages(S.status(spark, sf_dir, spread=True))
    msgs.select(F.col("value").cast("string").alias("value")).write.text(landing)
    stream = spark.readStream.schema("value string").text(landing)
    q = streaming.start_status_stream(stream, out, ckpt, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@_register("status_history",
           " SELECT CAST(user_id AS VARCHAR) AS station_id,"
           " CAST(floor(value) AS INTEGER) AS num_bikes_available,"
           " CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_docks_available,"
           " TRUE AS is_installed, event_type <> 'error' AS is_renting,"
           " event_type NOT IN ('view', 'purchase') AS is_returning,"
           " date_trunc('second', ts) AS last_reported,"
           " date_trunc('second', max(ts) OVER (PARTITION BY event_id // 2000)) AS inserted_at"
           " FROM events")
def q_status_history(spark, sf_dir):
    """Status feed snapshots landed as files (K5), picked up by a file stream
    (S3, T4), exploded and appended to the history with the snapshot time as
    arrival time (P-C: P8 F4 F11 K7)."""
    run = fresh_dir(spark, "status_history")
    landing, out, ckpt = f"{run}/landing", f"{run}/history", f"{run}/checkpoint"
    docs = S.status_feed_docs(S.table(spark, sf_dir, "events"), block=S.SNAPSHOT_BLOCK)
    sinks.write_snapshots(docs, landing)
    q = streaming.start_feed_history(feed_src.stream_snapshots(spark, landing), out, ckpt,
                                     available_now=True)
    q.awaitTermination()
    return spark.read.schema(schemas.STATION_STATUS).parquet(out).drop("batch_id")


@_register("history_compacted",
           " SELECT CAST(user_id AS VARCHAR) AS station_id,"
           " CAST(floor(value) AS INTEGER) AS num_bikes_available,"
           " CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_docks_available,"
           " TRUE AS is_installed, event_type <> 'error' AS is_renting,"
           " event_type NOT IN ('view', 'purchase') AS is_returning,"
           " date_trunc('second', ts) AS last_reported,"
           " date_trunc('second', max(ts) OVER (PARTITION BY event_id // 2000)) AS inserted_at"
           " FROM events")
def q_history_compacted(spark, sf_dir):
    """The status history as in ``status_history``, streamed in two goes of
    several batches with a compaction after each and the covered batches
    removed: read from compacted days and the newest batch (K7)."""
    run = fresh_dir(spark, "history_compacted")
    landing, out, ckpt = f"{run}/landing", f"{run}/history", f"{run}/checkpoint"
    docs = S.status_feed_docs(S.table(spark, sf_dir, "events"), block=S.SNAPSHOT_BLOCK)
    early = F.col("snapshot_id") % 2 == 0
    for part in (docs.filter(early), docs.filter(~early)):
        sinks.write_snapshots(part, landing)
        files = max(1, len(spark.read.option("recursiveFileLookup", "true").text(landing).inputFiles()) // 8)
        stream = feed_src.stream_snapshots(spark, landing, max_files_per_trigger=files)
        streaming.start_feed_history(stream, out, ckpt, available_now=True).awaitTermination()
        compaction.compact(spark, out, schemas.STATION_STATUS, F.to_date("inserted_at"))
    compaction.remove_covered(spark, out, keep_seconds=0)
    return compaction.read_history(spark, out, schemas.STATION_STATUS)


@_register("status_feed_messages",
           " SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(floor(value) AS INTEGER) AS bikes,"
           " CASE event_type WHEN 'view' THEN 'absent' WHEN 'purchase' THEN '0' ELSE '1' END AS is_returning,"
           " epoch_us(ts) // 1000000 AS last_reported FROM events")
def q_status_feed_messages(spark, sf_dir):
    """The status feed job's second sink (P-C, K3): each station object as it
    was sent, published (to files in place of the topic) and read back."""
    run = fresh_dir(spark, "status_messages")
    docs = S.status_feed_docs(S.table(spark, sf_dir, "events"), block=S.SNAPSHOT_BLOCK)
    sinks.write_snapshots(docs, f"{run}/landing")
    topic = streaming.batch_partition_writer(f"{run}/topic")
    q = streaming.start_feed_history(feed_src.stream_snapshots(spark, f"{run}/landing"), f"{run}/history",
                                     f"{run}/checkpoint", available_now=True, publish=topic)
    q.awaitTermination()
    value = tf.binary_to_text("value")
    absent = ~tf.json_has_key(value, "is_returning")
    return spark.read.parquet(f"{run}/topic").select(
        tf.binary_to_text("key").alias("station_id"),
        F.get_json_object(value, "$.num_bikes_available").cast("int").alias("bikes"),
        F.when(absent, "absent").otherwise(F.get_json_object(value, "$.is_returning")).alias("is_returning"),
        F.get_json_object(value, "$.last_reported").cast("long").alias("last_reported"))


@_register("station_info_feed",
           O.with_(snaps="SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(floor(c_custkey / 2000) AS INTEGER))"
                         " AS snap FROM customer")
           + " SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS name,"
             " CAST(c_custkey AS VARCHAR) || '.10' AS short_name, c_acctbal / 100 AS lat,"
             " CAST(c_nationkey AS DOUBLE) AS lon, c_mktsegment AS region_id,"
             " CAST(c_nationkey AS INTEGER) AS capacity, FALSE AS eightd_has_key_dispenser,"
             " CASE c_mktsegment WHEN 'AUTOMOBILE' THEN FALSE WHEN 'BUILDING' THEN NULL"
             " ELSE c_acctbal >= 0 END AS has_kiosk, TRUE AS installed, snap AS last_reported,"
             " (SELECT max(snap) FROM snaps) AS created_at, (SELECT max(snap) FROM snaps) AS updated_at FROM snaps")
def q_station_info_feed(spark, sf_dir):
    """Metadata snapshots landed, streamed once and folded into the versioned
    station table by the job (P-D: S4 K5 P8 F12 K8)."""
    run = fresh_dir(spark, "info_feed")
    docs = S.info_feed_docs(S.table(spark, sf_dir, "customer"), block=S.SNAPSHOT_BLOCK)
    base = F.lit(S.INFO_EPOCH).cast("timestamp_ntz")
    docs = docs.withColumn("snapshot_time", F.timestamp_add("DAY", F.col("snapshot_id").cast("int"), base))
    sinks.write_snapshots(docs, f"{run}/landing")
    jobs.upsert_station_information(spark, f"{run}/landing", f"{run}/table", f"{run}/checkpoint")
    return sinks.read_current(spark, f"{run}/table", schemas.STATION_INFORMATION)


_MONTH = "1996-03-01"


@_register("month_partition_read",
           O.with_(trips=O.TRIPS) + f" SELECT * FROM trips WHERE month = DATE '{_MONTH}'")
def q_month_partition_read(spark, sf_dir):
    """Trips written as Parquet by month (K4), read back for one month: the
    scan reads only that month's folder (partition pruning)."""
    out = fresh_dir(spark, "trips_by_month")
    sinks.write_by_month(S.trips(spark, sf_dir, spread=True), out)
    back = spark.read.schema(schemas.TRIP).parquet(out)
    return back.filter(F.col("month") == F.lit(_MONTH).cast("date")).select(*schemas.TRIP_COLUMNS)


@_register("station_transform_written",
           O.with_(status=O.STATUS, info=O.INFO) + O.STATION_AGG)
def q_station_transform_written(spark, sf_dir):
    """The station aggregate written partitioned by aggregation_date
    and read back whole."""
    out = fresh_dir(spark, "station_status_transformed")
    sinks.write_partitioned(_station_agg(spark, sf_dir), out, ["aggregation_date"])
    return spark.read.schema(schemas.STATION_STATUS_TRANSFORMED).parquet(out)


_TWO_RUNS = O.with_(status=O.STATUS, info=O.INFO, again="SELECT * FROM status WHERE is_renting") \
    + f" SELECT 'run1' AS run_id, a.* FROM ({O.STATION_AGG}) a UNION ALL SELECT 'run2' AS run_id, b.* FROM (" \
    + re.sub(r"\bstatus\b", "again", O.STATION_AGG) + ") b"


@_register("station_transform_two_runs", _TWO_RUNS)
def q_station_transform_two_runs(spark, sf_dir):
    """Two runs of the station transform into one history (K11), the second
    with only the renting reports, and tried twice: all rows of the first run
    stay, the second's are there once."""
    out = fresh_dir(spark, "station_history")
    status, info = S.status(spark, sf_dir), S.info(spark, sf_dir)
    jobs.transform_stations(spark, status, info, out, run_id="run1")
    for _ in range(2):
        jobs.transform_stations(spark, status.filter("is_renting"), info, out, run_id="run2")
    fields = schemas.STATION_STATUS_TRANSFORMED.fieldNames()
    return spark.read.parquet(out).select("run_id", *fields)


# ---------------------------------------------------------------------------
# operators for training-data tables: an optional subpackage and its pipeline

try:
    import corpus_pipeline
    from tripflow.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("tripflow.llm", "corpus_pipeline")):
        raise
else:
    for _name, _query in corpus_queries.QUERIES.items():
        _register(_name, corpus_queries.SQL.get(_name))(_query)
    _register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (station aggregate) on /root/testdata/sf0.001."""
    return queries()["station_aggregate"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query that has a relational equivalent."""
    return dict(_SQL)
