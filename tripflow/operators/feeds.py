"""Station feeds: snapshot documents and per-station messages to table rows
(P7, P8, F1-F4, F11, F12, T1, K3).

Works the same on batch and streaming frames: nothing here aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import functions as tf
from tripflow import schemas
from tripflow.operators.quality import reason_column

_RAW_STATIONS = "data struct<stations: array<string>>"


def station_objects(docs: DataFrame, doc_col: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of ``data.stations`` with the element's raw JSON
    text in ``station`` (P8). A document without ``data`` or ``stations``,
    or one that is not JSON, gives no rows.

    Keeping the element as text lets callers tell an absent key from an
    explicit null (F12) before typing it.
    """
    parsed = tf.parse_json(doc_col, _RAW_STATIONS)
    return docs.select(*keep, F.explode(parsed.getField("data").getField("stations")).alias("station"))


def _typed(station_text: Column, schema: StructType) -> Column:
    return tf.parse_json(station_text, schema)


def status_rows(stations: DataFrame, station_col: str = "station", inserted_at=None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Station-status elements to ``station_status`` rows (P-C, F4, F11).

    Flags 1/true are true; 0, false, null or absent are false. Epoch-second
    ``last_reported`` becomes a zone-less UTC timestamp; when it is absent the
    row keeps a null time (D13) for the quality step to quarantine. Counts
    beyond the int range are null.
    """
    s = _typed(F.col(station_col), schemas.STATUS_FEED_STATION)
    return stations.select(
        *keep,
        s.getField("station_id").alias("station_id"),
        tf.narrow(s.getField("num_bikes_available")).alias("num_bikes_available"),
        tf.narrow(s.getField("num_docks_available")).alias("num_docks_available"),
        tf.truthy(s.getField("is_installed")).alias("is_installed"),
        tf.truthy(s.getField("is_renting")).alias("is_renting"),
        tf.truthy(s.getField("is_returning")).alias("is_returning"),
        tf.epoch_to_timestamp(s.getField("last_reported"), "s").alias("last_reported"),
        tf.now(inserted_at).alias("inserted_at"),
    )


# Metadata flags that default to false when the key is absent.
INFO_DEFAULT_FALSE = ["eightd_has_key_dispenser", "has_kiosk", "installed"]


def info_rows(stations: DataFrame, station_col: str = "station", as_of=None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Station-information elements to ``station_information`` rows (P-D).

    The three flags default to false only when the key is absent; an explicit
    null stays null (F12). ``last_reported`` is the snapshot time ``as_of``
    (or the current time), as the feed carries none.
    """
    text = F.col(station_col)
    s = _typed(text, schemas.INFO_FEED_STATION)
    cols = []
    for f in schemas.INFO_FEED_STATION.fields:
        v = s.getField(f.name)
        if f.name in INFO_DEFAULT_FALSE:
            v = tf.default_if_absent(text, f.name, v, False)
        cols.append(v.alias(f.name))
    stamp = tf.now(as_of)
    return stations.select(*keep, *cols, stamp.alias("last_reported"))


def to_station_messages(stations: DataFrame, station_col: str = "station") -> DataFrame:
    """Elements of a feed document to topic messages (K3): ``key`` =
    station_id, ``value`` = the whole element as sent, every key and explicit
    null included."""
    text = F.col(station_col)
    key = tf.parse_json(text, "station_id string").getField("station_id")
    return stations.select(key.cast("binary").alias("key"), text.cast("binary").alias("value"))


def to_status_messages(status: DataFrame) -> DataFrame:
    """``station_status`` rows to one JSON message per station with the fields
    that the topic's readers use (F3): ``key`` = station_id, ``value`` = bytes."""
    body = tf.record_to_json(
        "station_id", "num_bikes_available", "num_docks_available",
        tf.timestamp_to_epoch("last_reported", "s").alias("last_reported"),
    )
    return status.select(
        F.col("station_id").cast("binary").alias("key"), body.cast("binary").alias("value")
    )


def parse_status_messages(messages: DataFrame, value_col: str = "value", unit: str = "s",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic messages to typed status rows (T1 = F2 + F1 + P7 + F4).

    Malformed text gives a row of nulls; a non-numeric or out-of-int-range
    count is null in that field only. ``unit`` is the epoch unit of
    ``last_reported`` (the feed uses seconds, D7).
    """
    data = tf.parse_json(tf.binary_to_text(value_col), schemas.STATUS_MESSAGE).alias("data")
    return messages.select(*keep, data).select(
        *keep,
        F.col("data.station_id").alias("station_id"),
        tf.narrow("data.num_bikes_available").alias("num_bikes_available"),
        tf.narrow("data.num_docks_available").alias("num_docks_available"),
        tf.epoch_to_timestamp("data.last_reported", unit).alias("last_reported"),
    )


def status_defects() -> Column:
    """Reason text for a status row that cannot be stored, else null."""
    return reason_column([
        ("no_station_id", F.col("station_id").isNull()),
        ("no_last_reported", F.col("last_reported").isNull()),
    ])
