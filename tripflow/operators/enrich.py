"""Trips enriched with their start and end station (P-F)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.operators.joins import DEFAULT_BROADCAST_BYTES, join_side


def station_role(stations: DataFrame, prefix: str) -> DataFrame:
    """The station frame seen as one trip end: 9 columns named
    ``{prefix}_station_short_name``, ``{prefix}_station_name``, ``{prefix}_lat``, ... (P3)."""
    return stations.select(
        *[F.col(src).alias(f"{prefix}_{suffix}") for src, suffix in schemas.ENRICH_STATION_COLUMNS]
    )


def trip_side(trips: DataFrame) -> DataFrame:
    """The 14 trip columns, with the four that clash with station columns
    renamed ``original_*`` (P1, P2)."""
    return trips.select(*schemas.TRIP_COLUMNS).withColumnsRenamed(schemas.TRIP_RENAMES)


def enrich_trips(trips: DataFrame, stations: DataFrame,
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``agg_tripdata``: every trip left-joined to the station rows whose
    ``short_name`` equals its start id, then to those equal to its end id
    (J2, J3).

    A trip with no match, or a null id, keeps null station columns. A
    short_name held by n station rows yields n copies of the trip (n×m when
    both ends repeat); pass :func:`latest_per_station` output to get exactly
    one row per trip.

    Hand over a written station table: under ``max_broadcast_bytes`` of it
    both joins are broadcast hash joins in the trips' own stage, so the trips
    are never shuffled. Above it, or where the size is only an upper estimate
    that is too large, Spark picks the joins.
    """
    cols = [src for src, _ in schemas.ENRICH_STATION_COLUMNS]
    side = join_side(stations.select(*cols), max_broadcast_bytes)
    start, end = station_role(side, "start"), station_role(side, "end")
    t = trip_side(trips)
    return (
        t.join(start, F.col("start_station_id") == F.col("start_station_short_name"), "left")
        .join(end, F.col("end_station_id") == F.col("end_station_short_name"), "left")
    )
