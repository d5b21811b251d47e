"""The station aggregate from states that are kept between runs."""

import datetime as dt
import os
import tempfile

from conftest import rows
from tripflow import schemas, streaming
from tripflow.operators import stations
from tripflow.plans import increments

T = dt.datetime


def test_increments_late_days_and_replays(spark, monkeypatch):
    monkeypatch.setattr(increments, "MOST_RUNS", 2)
    root = tempfile.mkdtemp(prefix="tripflow-incr-")
    history, states = os.path.join(root, "history"), os.path.join(root, "states")
    append = streaming.batch_partition_writer(history)
    info = spark.createDataFrame(
        [(s, s, s, 1.0, 2.0, "r", 5, False, True, True, T(2024, 9, 1), T(2024, 9, 1), T(2024, 9, 1)) for s in "ab"],
        schemas.STATION_INFORMATION)

    def batch(n, days):
        data = [(s, n + i, None if i == 1 else i, True, i % 2 == 0, True, T(2024, 1, d, n, i), None)
                for s in "abc" for i, d in enumerate(days)]
        append(spark.createDataFrame(data, schemas.STATION_STATUS), n)

    for n, days in enumerate([(5, 5, 6), (6, 7), (1, 8), (8, 9), (2, 9)]):  # days 1 and 2 come late
        batch(n, days)
        got = increments.station_aggregate_incremental(spark, history, states, info)
        whole = spark.read.schema(schemas.STATION_STATUS).parquet(history).drop("batch_id")
        assert rows(got) == rows(stations.station_aggregate(whole, info))
        # the run covers all but the newest batch, which is written again
        assert [u for _, u in increments._runs(spark, states)][-1:] == ([n - 1] if n else [])
        batch(n, days)
        assert rows(increments.station_aggregate_incremental(spark, history, states, info)) == rows(got)
    assert len(increments._runs(spark, states)) <= 2
