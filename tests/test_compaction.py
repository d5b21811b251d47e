"""Compaction of an appended history."""

import datetime as dt
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripflow import schemas, streaming
from tripflow.sinks import compaction

T = dt.datetime


def day():
    return F.to_date("inserted_at")


@pytest.fixture
def history(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tripflow-compact-"), "history")
    write = streaming.batch_partition_writer(path)

    def append(batch, n=40):
        rows = [(f"s{i}", batch, i, True, True, i % 2 == 0, T(2024, 1, 1 + i % 3, 1, i), None if i == 7 else T(2024, 1, 1 + i % 3))
                for i in range(n)]
        write(spark.createDataFrame(rows, schemas.STATION_STATUS).repartition(4), batch)

    return path, append


def seen(spark, path):
    return Counter(r["num_bikes_available"] for r in compaction.read_history(spark, path, schemas.STATION_STATUS).collect())


def test_rows_once_while_the_stream_goes_on(spark, history):
    path, append = history
    assert seen(spark, path) == {} and compaction.compact(spark, path, schemas.STATION_STATUS, day()) == 0
    for b in range(4):
        append(b)
    assert compaction.compact(spark, path, schemas.STATION_STATUS, day(), rows_per_file=25) == 3
    assert seen(spark, path) == dict.fromkeys(range(4), 40)
    files = spark.read.parquet(f"{path}_compacted/data").select(F.input_file_name().alias("f"), "day")
    per_day = {r["day"]: (r["n"], r["files"]) for r in files.groupBy("day").agg(
        F.count("*").alias("n"), F.count_distinct("f").alias("files")).collect()}
    assert len(per_day) == 4 and all(k <= n // 25 + 1 for n, k in per_day.values())
    append(3)  # the newest batch written again by a restarted stream
    append(4)
    assert seen(spark, path) == dict.fromkeys(range(5), 40)
    assert compaction.compact(spark, path, schemas.STATION_STATUS, day()) == 1
    assert compaction.remove_covered(spark, path) == 0  # readers may still have them
    assert compaction.remove_covered(spark, path, keep_seconds=0) == 4
    assert compaction.batches(spark, path) == [4] and seen(spark, path) == dict.fromkeys(range(5), 40)
    assert compaction.compact(spark, path, schemas.STATION_STATUS, day()) == 0


def test_a_broken_compaction_loses_nothing(spark, history, monkeypatch):
    path, append = history
    for b in range(3):
        append(b)

    def lost(*_):
        raise RuntimeError("driver lost before the manifest")

    with monkeypatch.context() as m:
        m.setattr(compaction.sinks, "commit_version", lost)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, path, schemas.STATION_STATUS, day())
    assert len(os.listdir(f"{path}_compacted/data")) == 1 and seen(spark, path) == dict.fromkeys(range(3), 40)
    assert compaction.compact(spark, path, schemas.STATION_STATUS, day()) == 2
    assert seen(spark, path) == dict.fromkeys(range(3), 40)
    assert compaction.remove_covered(spark, path, keep_seconds=0) == 3  # two batches and the orphaned run
    assert seen(spark, path) == dict.fromkeys(range(3), 40)
