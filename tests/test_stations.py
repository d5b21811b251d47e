import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tripflow import schemas
from tripflow.operators import stations

T = dt.datetime


def status_df(spark, data):
    return spark.createDataFrame(data, schemas.STATION_STATUS)


def info_df(spark, data):
    return spark.createDataFrame(data, schemas.STATION_INFORMATION)


def info_row(sid, name="n", short="s", region="r", created=T(2024, 1, 1), reported=T(2024, 1, 2)):
    return (sid, name, short, 40.0, -73.0, region, 10, False, True, True, reported, created, created)


def join_then_group(status, info):
    """The plain plan: join every status row, then group by the 12 keys."""
    s = status.withColumnRenamed("last_reported", "status_last_reported")
    j = s.join(info.drop("created_at", "updated_at", "eightd_has_key_dispenser"), "station_id")
    return j.groupBy(*schemas.STATION_KEYS).agg(
        F.avg("num_bikes_available").alias("avg_bikes_available"),
        F.avg("num_docks_available").alias("avg_docks_available"),
        F.max("status_last_reported").alias("status_last_reported"),
        F.max("last_reported").alias("info_last_reported"),
    ).withColumn("aggregation_date", F.to_date("status_last_reported"))


def test_aggregate_matches_join_then_group(spark):
    status = status_df(spark, [
        ("a", 1, 5, True, True, True, T(2024, 10, 1, 8), None),
        ("a", 3, None, True, True, True, T(2024, 10, 1, 9), None),
        ("a", 2, 2, True, False, True, T(2024, 10, 2, 9), None),
        ("b", None, None, True, True, None, T(2024, 10, 3), None),
        ("zzz", 7, 7, True, True, True, T(2024, 10, 3), None),  # no metadata: dropped
        (None, 7, 7, True, True, True, T(2024, 10, 3), None),  # null key never joins
    ])
    info = info_df(spark, [info_row("a"), info_row("b", region=None), info_row(None)])
    got = stations.station_aggregate(status, info)
    assert got.columns == [f.name for f in schemas.STATION_STATUS_TRANSFORMED.fields]
    assert rows(got) == rows(join_then_group(status, info).select(*got.columns))
    a = {(r.is_renting,): r for r in got.filter("station_id = 'a'").collect()}
    assert a[(True,)].avg_bikes_available == 2.0 and a[(True,)].avg_docks_available == 5.0
    b = got.filter("station_id = 'b'").first()
    assert b.avg_bikes_available is None and b.region_id is None


def test_aggregate_exact_with_repeated_metadata(spark):
    status = status_df(spark, [("a", 1, 1, True, True, True, T(2024, 10, 1), None),
                               ("a", 4, 1, True, True, True, T(2024, 10, 2), None)])
    info = info_df(spark, [info_row("a", reported=T(2024, 1, 2)), info_row("a", reported=T(2024, 1, 5)),
                           info_row("a", name="other")])
    got = stations.station_aggregate(status, info)
    assert rows(got) == rows(join_then_group(status, info).select(*got.columns))
    assert got.count() == 2


def test_latest_per_station(spark):
    status = status_df(spark, [
        ("a", 1, 1, True, True, True, T(2024, 10, 1), None),
        ("a", 1, 1, True, False, True, T(2024, 10, 5), None),
        ("b", 1, 1, True, True, True, T(2024, 10, 1), None),
    ])
    info = info_df(spark, [info_row("a"), info_row("b")])
    latest = stations.latest_per_station(stations.station_aggregate(status, info))
    got = {r.station_id: r for r in latest.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].is_renting is False
    assert latest.columns == stations.station_aggregate(status, info).columns


def test_renting_only_drops_null_and_false(spark):
    status = status_df(spark, [("a", 1, 1, True, True, True, T(2024, 1, 1), None),
                               ("b", 1, 1, True, False, True, T(2024, 1, 1), None),
                               ("c", 1, 1, True, None, True, T(2024, 1, 1), None)])
    out = stations.renting_only(status, drop=("inserted_at",))
    assert rows(out, "station_id") == [("a",)]
    assert "inserted_at" not in out.columns


def test_aggregate_plan_has_one_status_shuffle(spark):
    status = status_df(spark, [("a", 1, 1, True, True, True, T(2024, 10, 1), None)])
    info = info_df(spark, [info_row("a")])
    plan = stations.station_aggregate(status, info)._jdf.queryExecution().executedPlan().toString()
    # partial aggregate on the status side before the only exchange
    assert "partial_sum" in plan
