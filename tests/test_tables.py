import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tripflow import schemas
from tripflow.operators import tables

T = dt.datetime
VALUES = ["name", "short_name", "lat", "lon", "region_id", "capacity",
          "eightd_has_key_dispenser", "has_kiosk", "installed", "last_reported"]
AS_OF = "2024-12-01 00:00:00"


def info(spark, data):
    return spark.createDataFrame(data, schemas.STATION_INFORMATION)


def row(sid, name, cap, created=T(2024, 1, 1), updated=T(2024, 1, 1), reported=T(2024, 1, 1)):
    return (sid, name, "s" + str(sid), 1.0, 2.0, "r", cap, False, True, True, reported, created, updated)


def test_upsert_cases(spark):
    existing = info(spark, [row("keep", "k", 1), row("change", "c", 1), row("gone", "g", 1),
                            row(None, "nullkey-old", 1)])
    updates = info(spark, [row("change", "c2", 2, reported=T(2024, 6, 1)),
                           row("change", "c3", 3, reported=T(2024, 7, 1)),  # later snapshot wins
                           row("new", "n", 5, reported=T(2024, 7, 1)),
                           row(None, "nullkey-new", 1)]).withColumn("version", F.col("last_reported"))
    out = tables.upsert(existing, updates, "station_id", VALUES, version="version", as_of=AS_OF)
    got = {(r.station_id, r.name): r for r in out.collect()}
    asof = T(2024, 12, 1)
    assert set(got) == {("keep", "k"), ("change", "c3"), ("gone", "g"), ("new", "n"),
                        (None, "nullkey-old"), (None, "nullkey-new")}
    assert got[("change", "c3")].capacity == 3
    assert got[("change", "c3")].created_at == T(2024, 1, 1) and got[("change", "c3")].updated_at == asof
    assert got[("new", "n")].created_at == asof and got[("new", "n")].updated_at == asof
    assert got[("keep", "k")].updated_at == T(2024, 1, 1)


def test_upsert_is_idempotent(spark):
    existing = info(spark, [row("a", "a", 1), row("b", "b", 1)])
    updates = info(spark, [row("b", "b2", 2), row("c", "c", 3)])
    once = tables.upsert(existing, updates, "station_id", VALUES, as_of=AS_OF)
    twice = tables.upsert(once.select(*existing.columns), updates, "station_id", VALUES, as_of=AS_OF)
    assert rows(once.select(*existing.columns)) == rows(twice.select(*existing.columns))


def test_insert_if_absent(spark):
    incoming = spark.createDataFrame(
        [("r1", 3), ("r1", 1), ("r2", 5), ("r3", 1), ("r3", 1), (None, 9), (None, 9)], "ride_id string, v int")
    target = spark.createDataFrame([("r2",)], "ride_id string")
    out = tables.insert_if_absent(incoming, target, ["ride_id"], ["v"])
    assert rows(out) == [("r1", 1), ("r3", 1)]  # a null key cannot be inserted


def test_first_per_key_independent_of_partitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") * 13 % 101).alias("v"))
    a = tables.first_per_key(df, ["k"], ["v"])
    b = tables.first_per_key(df.repartition(17), ["k"], ["v"])
    assert rows(a) == rows(b)
    assert a.count() == 7


def test_insert_if_absent_probe_paths_agree_and_target_not_shuffled(spark):
    incoming = spark.range(0, 500).select((F.col("id") % 300).cast("string").alias("ride_id"),
                                          F.col("id").alias("v"))
    target = spark.range(0, 5000, 3).select(F.col("id").cast("string").alias("ride_id"))
    small = tables.insert_if_absent(incoming, target, ["ride_id"], ["v"])
    big = tables.insert_if_absent(incoming, target, ["ride_id"], ["v"], max_broadcast_bytes=0)
    assert rows(small) == rows(big)
    assert small.count() == 200
    small.collect()
    plan = small._jdf.queryExecution().executedPlan().toString()
    # the target's keys are probed against the broadcast load keys where they are scanned
    assert "LeftSemi, BuildRight" in plan


def test_upsert_keeps_repeated_null_key_rows(spark):
    existing = info(spark, [row(None, "same", 1), row(None, "same", 1), row("a", "a", 1)])
    updates = info(spark, [row(None, "same", 1), row("a", "a2", 2)])
    out = tables.upsert(existing, updates, "station_id", VALUES, as_of=AS_OF)
    got = sorted((r.station_id or "", r.name) for r in out.collect())
    assert got == [("", "same"), ("", "same"), ("", "same"), ("a", "a2")]
    assert out.filter("station_id IS NULL AND created_at = TIMESTAMP'2024-12-01 00:00:00'").count() == 1
