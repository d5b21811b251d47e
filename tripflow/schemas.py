"""Declared schemas of every table and message the jobs read or write.

Nothing is inferred: sources read with these ``StructType``s, and
:func:`conform` casts a frame to one of them by column name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Times are wall-clock values without a zone, like the relational tables they
# stand for; the session zone is UTC (see ``session.JOB_CONF``).
TS = TimestampNTZType()
COORD = DecimalType(9, 6)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Column names and order of the trip files and the trip table.
TRIP_CSV_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]
# Defaults for columns absent from a trip file.
TRIP_TIME_COLUMNS = ["started_at", "ended_at"]
TRIP_COORD_COLUMNS = ["start_lat", "start_lng", "end_lat", "end_lng"]
ABSENT_TEXT_DEFAULT = "unknown"
# Text cells read as missing (the pandas CSV reader's default
# missing-value tokens, as listed in its documentation).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
# Length limits of the trip table's text columns.
TRIP_TEXT_LIMITS = {
    "ride_id": 255,
    "rideable_type": 50,
    "start_station_name": 255,
    "start_station_id": 50,
    "end_station_name": 255,
    "end_station_id": 50,
    "member_casual": 50,
}
# Rows per written Parquet file, rows per relational batch.
ROWS_PER_FILE = 200_000
LOAD_BATCH_ROWS = 10_000

TRIP = _s(
    ("ride_id", StringType()),
    ("rideable_type", StringType()),
    ("started_at", TS),
    ("ended_at", TS),
    ("start_station_name", StringType()),
    ("start_station_id", StringType()),
    ("end_station_name", StringType()),
    ("end_station_id", StringType()),
    ("start_lat", COORD),
    ("start_lng", COORD),
    ("end_lat", COORD),
    ("end_lng", COORD),
    ("member_casual", StringType()),
    ("month", DateType()),
)
TRIP_COLUMNS = [f.name for f in TRIP.fields]

STATION_STATUS = _s(
    ("station_id", StringType()),
    ("num_bikes_available", IntegerType()),
    ("num_docks_available", IntegerType()),
    ("is_installed", BooleanType()),
    ("is_renting", BooleanType()),
    ("is_returning", BooleanType()),
    ("last_reported", TS),
    ("inserted_at", TS),
)

STATION_INFORMATION = _s(
    ("station_id", StringType()),
    ("name", StringType()),
    ("short_name", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("region_id", StringType()),
    ("capacity", IntegerType()),
    ("eightd_has_key_dispenser", BooleanType()),
    ("has_kiosk", BooleanType()),
    ("installed", BooleanType()),
    ("last_reported", TS),
    ("created_at", TS),
    ("updated_at", TS),
)

# Group keys of the station aggregate, in output order.
STATION_KEYS = [
    "station_id",
    "name",
    "short_name",
    "region_id",
    "lat",
    "lon",
    "capacity",
    "has_kiosk",
    "installed",
    "is_installed",
    "is_returning",
    "is_renting",
]
STATUS_FLAGS = ["is_installed", "is_renting", "is_returning"]

STATION_STATUS_TRANSFORMED = _s(
    ("station_id", StringType()),
    ("name", StringType()),
    ("short_name", StringType()),
    ("region_id", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("capacity", IntegerType()),
    ("has_kiosk", BooleanType()),
    ("installed", BooleanType()),
    ("is_installed", BooleanType()),
    ("is_returning", BooleanType()),
    ("is_renting", BooleanType()),
    ("avg_bikes_available", DoubleType()),
    ("avg_docks_available", DoubleType()),
    ("status_last_reported", TS),
    ("info_last_reported", TS),
    ("aggregation_date", DateType()),
)

# Station columns carried onto each trip end, as (source column, suffix).
ENRICH_STATION_COLUMNS = [
    ("short_name", "station_short_name"),
    ("name", "station_name"),
    ("lat", "lat"),
    ("lon", "lon"),
    ("capacity", "capacity"),
    ("avg_bikes_available", "avg_bikes_available"),
    ("avg_docks_available", "avg_docks_available"),
    ("status_last_reported", "status_last_reported"),
    ("info_last_reported", "info_last_reported"),
]
# Trip columns renamed before the joins so the station columns can take the name.
TRIP_RENAMES = {
    "start_station_name": "original_start_station_name",
    "start_lat": "original_start_lat",
    "end_station_name": "original_end_station_name",
    "end_lat": "original_end_lat",
}

# Feed documents: {"data": {"stations": [ ... ]}} with epoch-second times.
STATUS_FEED_STATION = _s(
    ("station_id", StringType()),
    ("num_bikes_available", LongType()),
    ("num_docks_available", LongType()),
    # flags come as 0/1 or true/false: kept as text, see functions.truthy
    ("is_installed", StringType()),
    ("is_renting", StringType()),
    ("is_returning", StringType()),
    ("last_reported", LongType()),
)
INFO_FEED_STATION = _s(
    ("station_id", StringType()),
    ("name", StringType()),
    ("short_name", StringType()),
    ("lat", DoubleType()),
    ("lon", DoubleType()),
    ("region_id", StringType()),
    ("capacity", IntegerType()),
    ("eightd_has_key_dispenser", BooleanType()),
    ("has_kiosk", BooleanType()),
    ("installed", BooleanType()),
)

# One status message per station on the topic. Counts are read as bigint so an
# out-of-range value can be range-checked instead of nulling the whole message.
STATUS_MESSAGE = _s(
    ("station_id", StringType()),
    ("num_bikes_available", LongType()),
    ("num_docks_available", LongType()),
    ("last_reported", LongType()),
)

INGESTION_LOG = _s(("file_name", StringType()), ("ingested_at", TS))
FAILED_INGESTION_LOG = _s(
    ("file_name", StringType()), ("error_message", StringType()), ("failed_at", TS)
)


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Select ``schema``'s columns by name, cast to its types.

    Absent columns become typed nulls unless ``strict`` (then
    :class:`ValueError` names them). Casts use ``try_cast`` so a bad value is
    null rather than a failed job.
    """
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present]
    if strict and missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
