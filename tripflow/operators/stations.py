"""Station status joined with station metadata, aggregated per station (P-E)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import functions as tf
from tripflow import schemas

_INFO_KEYS = [k for k in schemas.STATION_KEYS if k not in ("station_id", *schemas.STATUS_FLAGS)]


def status_partials(status: DataFrame) -> DataFrame:
    """Status history reduced to one row per (station_id, is_installed,
    is_renting, is_returning): sums and counts for the averages, latest time.

    This runs as a partial aggregate on every map task, so only a few rows per
    station and task are shuffled however many minutes of history there are,
    and a station holding a large share of the rows is combined before the
    shuffle.
    """
    return status.groupBy("station_id", *schemas.STATUS_FLAGS).agg(*_partials())


def _partials() -> list[Column]:
    return [
        F.sum("num_bikes_available").alias("bikes_sum"),
        F.count("num_bikes_available").alias("bikes_n"),
        F.sum("num_docks_available").alias("docks_sum"),
        F.count("num_docks_available").alias("docks_n"),
        F.max("last_reported").alias("status_last_reported"),
    ]


def station_aggregate(status: DataFrame, info: DataFrame) -> DataFrame:
    """``station_status_transformed``: status ⋈ info on station_id, grouped by
    the 12 station keys with average bikes and docks, latest status and
    metadata times, and the date of the latest status (J1, A1, F7).

    Same rows as joining every status row and grouping afterwards: a status row
    without metadata is dropped, null keys form their own group, averages skip
    nulls. The status side is aggregated before the join so the join sees one
    row per station and flag combination instead of the whole history; Spark
    broadcasts the metadata side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides.
    The regrouping after the join keeps the result exact even if the metadata
    repeats a station_id; its keys contain the first aggregate's shuffle keys,
    so it needs no second shuffle.
    """
    return aggregate_partials(status_partials(status), info)


def daily_partials(status: DataFrame) -> DataFrame:
    """:func:`status_partials` by day of the report. Partials of any parts of a
    history, in any order, are merged by aggregating them again."""
    return status.groupBy(tf.to_day("last_reported").alias("day"), "station_id", *schemas.STATUS_FLAGS).agg(*_partials())


def merge_partials(partials: DataFrame) -> DataFrame:
    """Daily partials of several parts as those of the whole."""
    return partials.groupBy("day", "station_id", *schemas.STATUS_FLAGS).agg(
        *(F.sum(c).alias(c) for c in ("bikes_sum", "bikes_n", "docks_sum", "docks_n")),
        F.max("status_last_reported").alias("status_last_reported"))


def aggregate_partials(parts: DataFrame, info: DataFrame) -> DataFrame:
    """:func:`station_aggregate` from partials of the history, which may come in
    several rows for a station and flags."""
    meta = info.select("station_id", *_INFO_KEYS, F.col("last_reported").alias("info_reported"))
    joined = parts.join(meta, "station_id", "inner")
    agg = joined.groupBy(*schemas.STATION_KEYS).agg(
        F.try_divide(F.sum("bikes_sum"), F.sum("bikes_n")).alias("avg_bikes_available"),
        F.try_divide(F.sum("docks_sum"), F.sum("docks_n")).alias("avg_docks_available"),
        F.max("status_last_reported").alias("status_last_reported"),
        F.max("info_reported").alias("info_last_reported"),
    )
    return agg.withColumn("aggregation_date", tf.to_day("status_last_reported")).select(
        *[f.name for f in schemas.STATION_STATUS_TRANSFORMED.fields]
    )


def latest_per_station(stations: DataFrame, key: str = "station_id",
                       order: tuple[str, ...] = ("status_last_reported", *schemas.STATUS_FLAGS)
                       ) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` columns.

    The remaining columns break ties, so the pick is deterministic. The
    aggregate's input is the station table (rows per station and run), and it
    is combined per task before the shuffle.
    """
    rest = [c for c in stations.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in (*order, *rest)])
    picked = stations.groupBy(key).agg(F.max(packed).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in (*order, *rest)]).select(
        *stations.columns
    )


def renting_only(status: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Status rows of stations that are renting; null counts as not."""
    out = status.filter(F.col("is_renting"))
    return out.drop(*drop) if drop else out
