import datetime as dt
import os
import tempfile

import pytest

from tripflow import schemas, sinks
from tripflow.operators import quality
from tripflow.sources import feeds as feed_src
from tripflow.sources import relational, topic

T = dt.datetime


def test_require_columns_and_order(spark):
    df = spark.createDataFrame([], schemas.TRIP)
    quality.require_columns(df, schemas.TRIP)
    assert quality.column_order_matches(df, schemas.TRIP_COLUMNS)
    with pytest.raises(quality.SchemaError, match="month"):
        quality.require_columns(df.drop("month"), schemas.TRIP_COLUMNS)
    assert not quality.column_order_matches(df.select("month", "ride_id"), ["ride_id", "month"])


def test_snapshot_write_read_round_trip(spark):
    root = tempfile.mkdtemp(prefix="tripflow-snap-")
    docs = spark.createDataFrame([(T(2024, 10, 1, 8, 0, 0), '{"data":{"stations":[{"station_id":"a"}]}}')],
                                 "snapshot_time timestamp_ntz, doc string")
    sinks.write_snapshots(docs, root)
    back = feed_src.read_snapshots(spark, root, glob="*.txt")
    assert back.count() == 1 and back.first().doc.startswith('{"data"')


def test_ensure_table_creates_once(spark):
    loc = tempfile.mkdtemp(prefix="tripflow-tbl-")
    sinks.ensure_table(spark, "trip_table_test", schemas.TRIP, loc, ["month"])
    sinks.ensure_table(spark, "trip_table_test", schemas.TRIP, loc, ["month"])
    cols = [c.name for c in spark.catalog.listColumns("trip_table_test")]
    assert set(cols) == set(schemas.TRIP_COLUMNS)


def test_option_builders():
    o = relational.jdbc_options("jdbc:x", "tripdata", {"user": "u"}, partition_column="id",
                                lower=0, upper=100, num_partitions=4)
    assert o["numPartitions"] == "4" and o["partitionColumn"] == "id" and o["user"] == "u"
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x", "t", partition_column="id")
    k = topic.kafka_source_options("h:9092", "station_status")
    assert k["subscribe"] == "station_status" and k["startingOffsets"] == "latest"
    assert sinks.kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_missing_manifest_reads_empty(spark):
    assert relational.read_manifest(spark, os.path.join(tempfile.mkdtemp(), "nope")).count() == 0


def test_read_cleaned_lineage(spark):
    from tripflow.sources import trips as trip_src
    root = os.path.join(tempfile.mkdtemp(), "cleaned")
    df = spark.createDataFrame(
        [(f"r{i}", "b", T(2024, 10, 1), T(2024, 10, 1), "s", "1", "e", "2", None, None, None, None, "m",
          dt.date(2024, 10, 1)) for i in range(5)], schemas.TRIP)
    sinks.write_by_month(df, root)
    back = trip_src.read_cleaned(spark, root)
    assert back.count() == 5
    assert sorted(r.source_row for r in back.collect()) == [0, 1, 2, 3, 4]
    assert back.filter("month = DATE'2024-10-01'").count() == 5


def test_conform_casts_and_fills(spark):
    raw = spark.createDataFrame([("r1", "2024-10-01 08:00:00", "40.1234567", "x")],
                                "ride_id string, started_at string, start_lat string, extra string")
    out = schemas.conform(raw, schemas.TRIP)
    assert out.columns == schemas.TRIP_COLUMNS
    r = out.first()
    assert r.started_at == T(2024, 10, 1, 8) and str(r.start_lat) == "40.123457" and r.month is None
    with pytest.raises(ValueError, match="month"):
        schemas.conform(raw, schemas.TRIP, strict=True)


def test_preview(spark):
    from tripflow.operators import metrics
    assert metrics.preview(spark.range(100)).count() == 5
