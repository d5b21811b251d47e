import datetime as dt
from decimal import Decimal

from conftest import rows
from tripflow import schemas
from tripflow.operators import enrich

T = dt.datetime
D = Decimal


def trip(rid, start, end):
    return (rid, "classic_bike", T(2024, 10, 1, 8), T(2024, 10, 1, 9), "S name", start, "E name", end,
            D("40.100000"), D("-73.100000"), D("40.200000"), D("-73.200000"), "member", dt.date(2024, 10, 1))


def station(short, name, bikes=1.0):
    return ("id-" + name, name, short, None, 40.0, -73.0, 12, True, True, True, True, True,
            bikes, 2.0, T(2024, 10, 1), T(2024, 9, 1), dt.date(2024, 10, 1))


def frames(spark):
    trips = spark.createDataFrame([
        trip("both", "A", "B"),
        trip("start-only", "A", "nowhere"),
        trip("none", "x", "y"),
        trip("null-id", None, None),
        trip("double", "D", "D"),
    ], schemas.TRIP)
    st = spark.createDataFrame([
        station("A", "alpha"), station("B", "beta"),
        station("D", "delta-1"), station("D", "delta-2", bikes=3.0),
    ], schemas.STATION_STATUS_TRANSFORMED)
    return trips, st


def test_columns_and_multiplicity(spark):
    trips, st = frames(spark)
    out = enrich.enrich_trips(trips, st)
    assert len(out.columns) == 32
    assert out.columns[:14] == [schemas.TRIP_RENAMES.get(c, c) for c in schemas.TRIP_COLUMNS]
    assert out.columns[14] == "start_station_short_name" and out.columns[-1] == "end_info_last_reported"
    counts = dict(rows(out.groupBy("ride_id").count()))
    # a short_name held by 2 station rows at both ends gives 2 x 2 copies
    assert counts == {"both": 1, "start-only": 1, "none": 1, "null-id": 1, "double": 4}
    r = out.filter("ride_id = 'start-only'").first()
    assert r.start_station_name == "alpha" and r.end_station_name is None
    assert r.original_start_station_name == "S name"
    n = out.filter("ride_id = 'null-id'").first()
    assert n.start_station_short_name is None and n.end_capacity is None


def test_broadcast_and_fallback_give_same_rows(spark):
    trips, st = frames(spark)
    small = enrich.enrich_trips(trips, st)
    big = enrich.enrich_trips(trips, st, max_broadcast_bytes=0)
    assert rows(small) == rows(big)
    plan_small = final_plan(small)
    assert plan_small.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan_small
    # beyond the bound no hint is given: the logical plan has no broadcast hint
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_trip_side_not_shuffled_when_broadcast(spark):
    trips, st = frames(spark)
    out = enrich.enrich_trips(trips, st)
    plan = final_plan(out)
    # the only exchanges are the broadcasts of the station side
    assert "Exchange hashpartitioning" not in plan


def test_sides_released_after_block(spark):
    from tripflow.operators.joins import released_after

    trips, st = frames(spark)
    with released_after():
        out = enrich.enrich_trips(trips, st)
        n = out.count()
        cached = [r for r in spark.sparkContext._jsc.getPersistentRDDs().values()]
        assert n == 8 and cached
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) < len(cached)
