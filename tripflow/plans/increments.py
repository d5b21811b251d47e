"""Station aggregate of a growing history without reading it again.

Daily partial states (sums, counts, latest time by station and flags) of the
batches that are complete are kept as a table; a run reads the batches since the
last one only. Runs are published by a manifest that is committed as a whole, so
a run that breaks off leaves nothing behind that counts. The newest batch, which
a restarted stream may write again, is read each time and never kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import schemas, sinks
from tripflow.operators import stations
from tripflow.sinks.compaction import MANIFEST, batches

#: Runs that are kept beside each other before they are merged to one.
MOST_RUNS = 32


def _runs(spark: SparkSession, states_path: str) -> list[tuple[str, int]]:
    kept = sinks.read_current(spark, f"{states_path}/manifest", StructType.fromDDL(MANIFEST))
    return sorted(map(tuple, kept.collect()), key=lambda r: r[1])


def read_states(spark: SparkSession, states_path: str) -> DataFrame | None:
    """The states of all published runs; None before the first."""
    runs = _runs(spark, states_path)
    return spark.read.parquet(*(f"{states_path}/data/{run}" for run, _ in runs)) if runs else None


def _later(spark: SparkSession, history_path: str, first: int, last: int | None = None) -> DataFrame:
    rows = spark.read.schema(schemas.STATION_STATUS).parquet(history_path).filter(F.col("batch_id") >= first)
    return rows if last is None else rows.filter(F.col("batch_id") <= last)


def update_states(spark: SparkSession, history_path: str, states_path: str) -> int:
    """Add the states of the complete batches that no run has. Late reports are
    added to their day as others are. Returns the number of batches."""
    runs = _runs(spark, states_path)
    new = [b for b in batches(spark, history_path)[:-1] if not runs or b > runs[-1][1]]
    if not new:
        return 0
    run = uuid.uuid4().hex
    fresh = stations.daily_partials(_later(spark, history_path, new[0], new[-1]))
    if len(runs) >= MOST_RUNS:
        fresh, runs = stations.merge_partials(read_states(spark, states_path).unionByName(fresh)), []
    fresh.write.parquet(f"{states_path}/data/{run}")
    sinks.commit_version(spark.createDataFrame([*runs, (run, new[-1])], MANIFEST).coalesce(1), f"{states_path}/manifest")
    return len(new)


def station_aggregate_incremental(spark: SparkSession, history_path: str, states_path: str, info: DataFrame) -> DataFrame:
    """:func:`tripflow.operators.stations.station_aggregate` of the whole
    history, from the kept states and the batches after them."""
    update_states(spark, history_path, states_path)
    runs = _runs(spark, states_path)
    rest = stations.daily_partials(_later(spark, history_path, runs[-1][1] + 1 if runs else 0))
    kept = read_states(spark, states_path)
    return stations.aggregate_partials(rest if kept is None else kept.unionByName(rest), info)
