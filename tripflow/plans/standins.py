"""Bike-share shaped frames derived from the driver's test tables.

The bike tables themselves are not in the test data, so each query reads a
test table and maps it onto the bike schema with plain column expressions;
the row counts grow with the scale factor like the real feeds would.

* ``events``   → station_status  (user_id = station, value = bikes,
  props.k = docks, event_type decides the three flags, ts = last_reported)
* ``customer`` → station_information (c_custkey = station)
* ``lineitem`` → tripdata (l_suppkey = start station, l_partkey = end station)

:mod:`tripflow.plans.oracle` holds the same mappings as SQL.
"""

from __future__ import annotations

import uuid
import zipfile
from contextlib import ExitStack
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import functions as tf
from tripflow import schemas
from tripflow.operators.joins import UNKNOWN_BYTES, estimated_bytes
from tripflow.sources import spread_scan
from tripflow.sources.trips import file_of

# Fixed values of the stand-in mapping (shared with the SQL twin).
INFO_EPOCH = "2024-01-01 00:00:00"
SHORT_NAME_SUFFIX = ".10"


# Row keys of the test tables, used to spread a single-task scan.
ROW_KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
    "customer": ["c_custkey"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table. With ``spread``, its rows are dealt to tasks of a bounded
    size first, however few tasks its row groups make: worth a shuffle only when
    the per-row work after it is heavy (CSV text, wide join output), not for
    aggregates."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread and name in ROW_KEYS:
        return spread_scan(df, ROW_KEYS[name])
    return df


def _txt(c: str) -> F.Column:
    return F.col(c).cast("string")


def status_from_events(events: DataFrame) -> DataFrame:
    docks = tf.parse_json("props", "k INT").getField("k")
    return events.select(
        _txt("user_id").alias("station_id"),
        F.floor("value").cast("int").alias("num_bikes_available"),
        docks.alias("num_docks_available"),
        (F.col("event_type") != "signup").alias("is_installed"),
        (F.col("event_type") != "error").alias("is_renting"),
        (F.col("event_type") != "purchase").alias("is_returning"),
        F.col("ts").alias("last_reported"),
        F.col("ts").alias("inserted_at"),
    )


def info_from_customers(customer: DataFrame) -> DataFrame:
    base = F.lit(INFO_EPOCH).cast("timestamp_ntz")
    return customer.select(
        _txt("c_custkey").alias("station_id"),
        F.col("c_name").alias("name"),
        F.concat(_txt("c_custkey"), F.lit(SHORT_NAME_SUFFIX)).alias("short_name"),
        (F.col("c_acctbal") / 100).alias("lat"),
        F.col("c_nationkey").cast("double").alias("lon"),
        F.col("c_mktsegment").alias("region_id"),
        F.col("c_nationkey").cast("int").alias("capacity"),
        F.lit(False).alias("eightd_has_key_dispenser"),
        (F.col("c_acctbal") >= 0).alias("has_kiosk"),
        F.lit(True).alias("installed"),
        F.timestamp_add("MINUTE", F.col("c_custkey"), base).alias("last_reported"),
        base.alias("created_at"),
        base.alias("updated_at"),
    )


def trips_from_lineitem(lineitem: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return lineitem.select(
        *extra,
        F.concat(_txt("l_orderkey"), F.lit("-"), _txt("l_linenumber")).alias("ride_id"),
        F.when(flag == "A", "classic_bike").when(flag == "N", "electric_bike")
        .otherwise("docked_bike").alias("rideable_type"),
        F.col("l_shipdate").alias("started_at"),
        F.timestamp_add("MINUTE", F.col("l_quantity").cast("int"), F.col("l_shipdate")).alias("ended_at"),
        F.concat(F.lit("Station "), _txt("l_suppkey")).alias("start_station_name"),
        F.concat(_txt("l_suppkey"), F.lit(SHORT_NAME_SUFFIX)).alias("start_station_id"),
        F.concat(F.lit("Station "), _txt("l_partkey")).alias("end_station_name"),
        F.when((flag == "R") & (status == "O"), F.lit(None).cast("string"))
        .otherwise(F.concat(_txt("l_partkey"), F.lit(SHORT_NAME_SUFFIX))).alias("end_station_id"),
        tf.to_decimal(F.col("l_extendedprice") / 1000).alias("start_lat"),
        tf.to_decimal(-F.col("l_discount")).alias("start_lng"),
        tf.to_decimal("l_tax").alias("end_lat"),
        tf.to_decimal("l_quantity").alias("end_lng"),
        F.when(status == "O", "member").otherwise("casual").alias("member_casual"),
        tf.month_start("l_shipdate").alias("month"),
    )


def status(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return status_from_events(table(spark, sf_dir, "events", spread))


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return info_from_customers(table(spark, sf_dir, "customer"))


def trips(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem", spread))


assert [f.name for f in schemas.TRIP.fields] == schemas.TRIP_COLUMNS


# ---------------------------------------------------------------------------
# Raw trip CSV records (for the cleaning step), rendered from lineitem.
#
# One "file" per start month. Files of 1996 and 1999 put member_casual first;
# files of 2001 lack rideable_type. Start times carry a fraction on classic
# bikes; rows with a 10% discount have an unreadable start time; trips ending
# outside the system have NA as end id; the start latitude is price/100, out
# of the decimal(9,6) range for the dearest trips. Station names contain a
# comma, so they are quoted.

_LAYOUT_A = list(schemas.TRIP_CSV_COLUMNS)
_LAYOUT_B = ["member_casual"] + [c for c in schemas.TRIP_CSV_COLUMNS if c != "member_casual"]
_LAYOUT_C = [c for c in schemas.TRIP_CSV_COLUMNS if c != "rideable_type"]


def source_of_month() -> F.Column:
    """Name of the CSV file that a lineitem row belongs to."""
    return F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("-tripdata.csv"))


def _cell(*parts: str | F.Column) -> F.Column:
    """A CSV cell of ``parts`` as ``to_csv`` writes it: quoted where its texts
    hold a comma, a quote or a line break (the columns among them hold none),
    NA if a column is null."""
    quote = any(c in p for p in parts if isinstance(p, str) for c in ',"\r\n')
    texts = [p.replace('"', '""') if isinstance(p, str) else p.cast("string") for p in parts]
    if quote:
        texts = ['"', *texts, '"']
    return F.coalesce(F.concat(*[F.lit(t) if isinstance(t, str) else t for t in texts]), F.lit("NA"))


def raw_trip_records(lineitem: DataFrame, extra: int = 0, without: tuple[str, ...] = (),
                     pier: str = ", Pier", keep: tuple[str, ...] = ()) -> DataFrame:
    """``source, header, line`` text records, one per lineitem row. ``extra``
    columns of no meaning, with commas and quotes in them, are put among the
    others; columns ``without`` are left out of every file; ``pier`` ends the
    name of every start station. ``keep`` columns come before the records'
    (``source`` is then the one kept, if it is among them)."""
    t = trips_from_lineitem(lineitem, extra=("l_discount", "l_returnflag", "l_extendedprice", "l_shipdate", *keep))
    bad_start = F.col("l_discount") == 0.1
    fraction = F.col("l_returnflag") == "A"
    cells = {
        "ride_id": [F.col("ride_id")],
        "rideable_type": [F.col("rideable_type")],
        "started_at": [F.when(bad_start, F.lit("not a time"))
                       .when(fraction, F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS"))
                       .otherwise(F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"))],
        "ended_at": [F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss")],
        "start_station_name": [F.col("start_station_name"), pier],
        "start_station_id": [F.col("start_station_id")],
        "end_station_name": [F.col("end_station_name")],
        "end_station_id": [F.col("end_station_id")],
        "start_lat": [(F.col("l_extendedprice") / 100).try_cast("decimal(12,6)")],
        "start_lng": [F.col("start_lng")],
        "end_lat": [F.col("end_lat")],
        "end_lng": [F.col("end_lng")],
        "member_casual": [F.col("member_casual")],
    }

    noise = [f"extra_{i}" for i in range(extra)]
    cells.update({c: [f'{c}, "', F.col("ride_id"), '"'] for c in noise})

    def layout_of(columns, first):
        """Extra columns in front, or one after every column."""
        columns = [c for c in columns if c not in without]
        if first:
            return noise + columns
        return [c for i, c in enumerate(columns) for c in [c, *noise[i: i + 1]]] + noise[len(columns):]

    layout_a, layout_b, layout_c = layout_of(_LAYOUT_A, True), layout_of(_LAYOUT_B, False), layout_of(_LAYOUT_C, True)

    def render(layout):
        return F.concat_ws(",", *[F.col(f"_{c}") for c in layout])

    year = F.year("started_at")
    b_year, c_year = year.isin(1996, 1999), year == 2001
    line = F.when(b_year, render(layout_b)).when(c_year, render(layout_c)).otherwise(render(layout_a))
    header = (F.when(b_year, F.lit(",".join(layout_b)))
              .when(c_year, F.lit(",".join(layout_c)))
              .otherwise(F.lit(",".join(layout_a))))
    source = () if "source" in keep else (source_of_month().alias("source"),)
    made = t.select(*keep, *source, "started_at", *[_cell(*parts).alias(f"_{c}") for c, parts in cells.items()])
    return made.select(*keep, *([] if "source" in keep else ["source"]), header.alias("header"), line.alias("line"))


#: Bytes of the table, as stored, for which a source gets one more landed file.
MONTH_FILE_BYTES, YEAR_FILE_BYTES = 128 << 20, 16 << 20
#: Least number of files of a source.
SOURCE_FILES = 4


def land_csv_files(lineitem: DataFrame, path: str, yearly: bool = False, compression: str = "none", **layout) -> None:
    """Records of ``lineitem`` (:func:`raw_trip_records` with ``layout``) as text
    files, each with its header as the first line. A source (a month, or a year)
    is several files, more of them for a larger table, so that no task holds
    more than a bounded share of it. The table's own columns are shuffled and
    sorted; their much longer text is made afterwards, once."""
    size = estimated_bytes(lineitem)
    size = size if size < UNKNOWN_BYTES else 0
    files = max(SOURCE_FILES, size // (YEAR_FILE_BYTES if yearly else MONTH_FILE_BYTES))
    name = F.coalesce(source_of_month(), F.lit("none-tripdata.csv"))
    source = F.substring(name, 1, 4) if yearly else name
    rows = lineitem.select("*", source.alias("source"), F.lit(1).alias("place"),
                           F.pmod(F.xxhash64(*lineitem.columns), F.lit(files)).cast("int").alias("part"))
    # one row a month, told by numbers, before the sources' names are made
    months = lineitem.groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("m")).agg(
        F.min("l_shipdate").alias("l_shipdate"))
    heads = months.groupBy(source.alias("source")).agg(F.min("l_shipdate").alias("l_shipdate")).select(
        "*", F.lit(0).alias("place"), F.explode(F.sequence(F.lit(0), F.lit(files - 1).cast("int"))).alias("part"))
    # one task per landed file, its header before its lines
    dealt = rows.unionByName(heads, allowMissingColumns=True).repartition("source", "part") \
        .sortWithinPartitions("source", "part", "place")
    text = raw_trip_records(dealt, keep=("source", "part", "place"), **layout)
    fast = {"zlib.compress.level": "BEST_SPEED"} if compression == "gzip" else {}
    text.select("source", "part", F.when(F.col("place") == 0, F.col("header")).otherwise(F.col("line")).alias("line")) \
        .write.partitionBy("source", "part").options(compression=compression, **fast).text(path)


def land_archives(lineitem: DataFrame, folder: str) -> None:
    """Records of ``lineitem`` as zip archives below ``folder`` (a URI that all
    executors reach): one per task, with a CSV per source; every second CSV is a
    nested archive. Each is written under a name of its own and moved into place."""

    def write(batches):
        part, open_now, zf = TaskContext.get().partitionId(), None, None
        fs, root = file_of(folder)
        fs.create_dir(root, recursive=True)
        tmp = f"{root}/_{uuid.uuid4().hex}"
        with ExitStack() as whole, ExitStack() as entry:
            for b in batches:
                rows = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
                for source, group in groupby(rows, key=itemgetter(0)):
                    lines = [*group]
                    if zf is None:
                        zf = whole.enter_context(
                            zipfile.ZipFile(whole.enter_context(fs.open_output_stream(tmp)), "w", zipfile.ZIP_DEFLATED, compresslevel=1))
                    if source != open_now:
                        entry.close()
                        if int(source[:6]) % 2:
                            out = entry.enter_context(zf.open(source, "w"))
                        else:
                            inner = entry.enter_context(zipfile.ZipFile(
                                entry.enter_context(zf.open(source + ".zip", "w")), "w", zipfile.ZIP_DEFLATED, compresslevel=1))
                            out = entry.enter_context(inner.open(source, "w"))
                        out.write(lines[0][1].encode() + b"\n")
                        open_now = source
                    out.write("".join([f"{line}\n" for _, _, line in lines]).encode())
        if zf is not None:
            fs.move(tmp, f"{root}/trips-{part:05d}.zip")
        yield pa.RecordBatch.from_pydict({"part": [part]})

    # the table's own columns are sorted, their text is made afterwards
    rows = lineitem.withColumn("source", source_of_month()).sortWithinPartitions("source")
    raw_trip_records(rows, keep=("source",)).select("source", "header", "line") \
        .mapInArrow(write, "part long").write.format("noop").mode("overwrite").save()


# ---------------------------------------------------------------------------
# Feed documents, packed from events / customers in blocks of a fixed size so
# no document grows with the data.

FEED_BLOCK = 100
# A landed snapshot holds about as many elements as a city has stations.
SNAPSHOT_BLOCK = 2000


def status_feed_docs(events: DataFrame, block: int = FEED_BLOCK) -> DataFrame:
    """``snapshot_id, snapshot_time, doc``: station-status feed documents, one
    per block of ``block`` consecutive events, stamped with the
    block's latest event second. ``is_returning`` is left out of the element
    for view events (absent key)."""
    et = F.col("event_type")
    element = F.struct(
        F.col("user_id").cast("string").alias("station_id"),
        F.floor("value").alias("num_bikes_available"),
        tf.parse_json("props", "k INT").getField("k").alias("num_docks_available"),
        F.lit(1).alias("is_installed"),
        F.when(et == "error", 0).otherwise(1).alias("is_renting"),
        F.when(et == "view", F.lit(None)).when(et == "purchase", 0).otherwise(1).alias("is_returning"),
        tf.timestamp_to_epoch("ts", "s").alias("last_reported"),
    )
    snap = F.floor(F.col("event_id") / block).alias("snapshot_id")
    packed = events.groupBy(snap).agg(F.collect_list(element).alias("stations"),
                                      F.date_trunc("second", F.max("ts")).alias("snapshot_time"))
    doc = F.to_json(F.struct(F.struct(F.col("stations")).alias("data")))
    return packed.select("snapshot_id", "snapshot_time", doc.alias("doc"))


def info_feed_docs(customer: DataFrame, block: int = FEED_BLOCK) -> DataFrame:
    """``snapshot_id, doc``: station-information feed documents, one per block
    of ``block`` customers. ``has_kiosk`` is absent for AUTOMOBILE,
    explicitly null for BUILDING; ``eightd_has_key_dispenser`` is never sent."""
    seg = F.col("c_mktsegment")
    common = [
        F.col("c_custkey").cast("string").alias("station_id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(SHORT_NAME_SUFFIX)).alias("short_name"),
        (F.col("c_acctbal") / 100).alias("lat"),
        F.col("c_nationkey").cast("double").alias("lon"),
        seg.alias("region_id"),
        F.col("c_nationkey").alias("capacity"),
        F.lit(True).alias("installed"),
    ]
    absent = F.to_json(F.struct(*common))
    null_kiosk = F.to_json(F.struct(*common, F.lit(None).cast("boolean").alias("has_kiosk")),
                           {"ignoreNullFields": "false"})
    kiosk = F.to_json(F.struct(*common, (F.col("c_acctbal") >= 0).alias("has_kiosk")))
    element = F.when(seg == "AUTOMOBILE", absent).when(seg == "BUILDING", null_kiosk).otherwise(kiosk)
    snap = F.floor(F.col("c_custkey") / block).alias("snapshot_id")
    packed = customer.groupBy(snap).agg(F.collect_list(element).alias("stations"))
    doc = F.concat(F.lit('{"data":{"stations":['), F.array_join("stations", ","), F.lit("]}}"))
    return packed.select("snapshot_id", doc.alias("doc"))
