import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tripflow import functions as tf

T = dt.datetime


def one(spark, col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("x")).first().x


def test_truthy(spark):
    for v, want in [("1", True), ("0", False), ("true", True), ("false", False), (None, False),
                    ("2", True), ("junk", False)]:
        assert one(spark, tf.truthy("v"), v) is want, v


def test_parse_time(spark):
    assert one(spark, tf.parse_time("v"), "2024-10-01 08:00:00.5") == T(2024, 10, 1, 8, 0, 0, 500000)
    assert one(spark, tf.parse_time("v"), "2024-10-01 08:00:00") == T(2024, 10, 1, 8)
    assert one(spark, tf.parse_time("v"), "10/1/2014 00:00:36") == T(2014, 10, 1, 0, 0, 36)
    assert one(spark, tf.parse_time("v"), "nonsense") is None


def test_decimal_half_up_and_range(spark):
    assert one(spark, tf.to_decimal("v"), "40.7123455") == Decimal("40.712346")
    assert one(spark, tf.to_decimal("v"), "1000") is None


def test_epoch_round_trip(spark):
    ts = T(2024, 10, 1, 8, 0, 5, 250000)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    r = df.select(tf.timestamp_to_epoch("t", "s").alias("s"), tf.timestamp_to_epoch("t", "ms").alias("ms")).first()
    assert r.s == 1727769605 and r.ms == 1727769605250
    assert one(spark, tf.epoch_to_timestamp("v", "s"), 1727769605, "v long") == T(2024, 10, 1, 8, 0, 5)


def test_names(spark):
    assert one(spark, tf.name_matches("v"), "/data/202410-metro-tripdata.csv.zip") is True
    assert one(spark, tf.name_matches("v"), "/data/2024-metro-tripdata.zip") is False
    assert one(spark, tf.snapshot_time("v"), "s3://b/station_status_20241001080102.json") == T(2024, 10, 1, 8, 1, 2)


def test_null_tokens(spark):
    for v, want in [("NA", None), ("", None), ("null", None), ("N/A", None), ("x", "x"), (None, None)]:
        assert one(spark, tf.null_if_token("v"), v) == want, v


def test_default_if_absent(spark):
    col = tf.default_if_absent("v", "k", F.get_json_object("v", "$.k").cast("boolean"), False)
    assert one(spark, col, '{"a":1}') is False
    assert one(spark, col, '{"k":null}') is None
    assert one(spark, col, '{"k":true}') is True


def test_epoch_text_and_month_date(spark):
    assert one(spark, tf.epoch_to_text("v"), 1727769605, "v long") == "2024-10-01 08:00:05"
    assert str(one(spark, tf.to_month_date("v"), "2024-10-01")) == "2024-10-01"
    assert one(spark, tf.to_month_date("v"), "not a month") is None
    ts = spark.createDataFrame([(T(2024, 10, 31, 23, 59),)], "t timestamp_ntz")
    assert str(ts.select(tf.month_start("t")).first()[0]) == "2024-10-01"
