"""The Bloom filter of a load's keys, and the load that uses it."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tripflow import schemas, sinks, streaming
from tripflow.operators import bloom, tables


def test_filter_keeps_all_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("ride_id"))
    blocks = bloom.blocks_for(20_000)
    built = bloom.bloom_filter(keys, ["ride_id"], blocks)
    assert built.count() <= blocks == 5
    kept = bloom.may_hold(keys, ["ride_id"], built, blocks)
    assert kept.columns == ["ride_id"] and kept.count() == 20_000
    others = spark.range(100_000).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("ride_id"))
    assert bloom.may_hold(others, ["ride_id"], built, blocks).count() < 3_000


def test_two_key_columns_with_nulls(spark):
    keys = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "k long, v string")
    built = bloom.bloom_filter(keys, ["k", "v"], 1)
    assert bloom.may_hold(keys, ["k", "v"], built, 1).count() == 3


@pytest.fixture(scope="module")
def loads(spark):
    incoming = spark.range(6000).select((F.col("id") % 4000).cast("string").alias("ride_id"), F.col("id").alias("v"))
    target = spark.range(3000, 9000).select(F.col("id").cast("string").alias("ride_id"))
    out = tempfile.mkdtemp(prefix="tripflow-bloom-")
    incoming.write.mode("overwrite").parquet(f"{out}/incoming")
    target.write.mode("overwrite").parquet(f"{out}/target")
    return spark.read.parquet(f"{out}/incoming"), spark.read.parquet(f"{out}/target")


@pytest.mark.parametrize("bound", [1 << 30, 8192, 1])
def test_a_load_beyond_the_broadcast_gives_the_same_rows(spark, loads, bound):
    incoming, target = loads
    out = tables.insert_if_absent(incoming, target, ["ride_id"], ["v"], max_broadcast_bytes=bound)
    assert rows(out, "ride_id", "v") == sorted(((str(i), i) for i in range(3000)), key=lambda t: tuple((x is None, str(x)) for x in t))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("bitmap_construct_agg" in plan) == (bound == 8192)
    flagged = tables.flag_new(incoming, target, ["ride_id"], ["v"], F.col("v") >= 0, max_broadcast_bytes=bound)
    assert flagged.count() == 6000 and rows(flagged.filter("is_new"), "v") == rows(out, "v")


def test_a_load_leaves_one_file_a_month(spark):
    root = tempfile.mkdtemp(prefix="tripflow-files-")
    cleaned, table, ckpt = (os.path.join(root, p) for p in ("cleaned", "table", "ckpt"))
    month = F.date_add(F.lit("2024-01-01").cast("date"), 0)
    df = spark.range(0, 2000, 1, 16).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("ride_id"), F.lit("b").alias("rideable_type"),
        *[F.lit("2024-01-01 08:00:00").cast("timestamp_ntz").alias(c) for c in ("started_at", "ended_at")],
        *[F.lit("a").alias(c) for c in ("start_station_name", "start_station_id", "end_station_name", "end_station_id")],
        *[F.lit(None).cast("decimal(9,6)").alias(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")],
        F.lit("member").alias("member_casual"),
        F.add_months(month, (F.col("id") % 5).cast("int")).alias("month"))
    df.select(*schemas.TRIP_COLUMNS).write.partitionBy("month").parquet(cleaned)  # 80 files
    streaming.start_incremental_trip_load(spark, cleaned, table, ckpt).awaitTermination()
    loaded = spark.read.parquet(table)
    assert loaded.count() == 2000 and len(loaded.inputFiles()) == 5
    assert sinks.folder_bytes(spark, table) > 0
