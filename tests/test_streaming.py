import datetime as dt
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import rows
from tripflow import schemas, sinks, streaming
from tripflow.operators import feeds

T = dt.datetime


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="tripflow-stream-")
    landing = os.path.join(root, "landing")
    msgs = [f'{{"station_id":"{i % 7}","num_bikes_available":{i},"num_docks_available":1,'
            f'"last_reported":{1727769600 + i}}}' for i in range(200)] + ["broken"]
    spark.createDataFrame([(m,) for m in msgs], "value string").write.text(landing)
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    stream = spark.readStream.schema("value string").text(landing)
    q = streaming.start_status_stream(stream, out, ckpt, available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = feeds.parse_status_messages(spark.read.schema("value string").text(landing))
    before = rows(streamed.drop("batch_id"))
    assert before == rows(batch.filter("station_id IS NOT NULL AND last_reported IS NOT NULL"))
    bad = spark.read.parquet(out + "_quarantine").collect()
    assert [(r.raw, r.reason) for r in bad] == [("broken", "no_station_id,no_last_reported")]
    # replaying batch 0 with the same rows changes nothing
    writer = streaming.batch_partition_writer(out)
    writer(batch.filter("station_id IS NOT NULL"), 0)
    assert rows(spark.read.parquet(out).drop("batch_id")) == before


def test_incremental_trip_load_each_file_once(spark):
    root = tempfile.mkdtemp(prefix="tripflow-load-")
    cleaned, table, ckpt = (os.path.join(root, p) for p in ("cleaned", "table", "ckpt"))

    def trips(ids):
        return spark.createDataFrame(
            [(r, "classic_bike", T(2024, 10, 1), T(2024, 10, 1, 1), "a", "1", "b", "2",
              None, None, None, None, "member", dt.date(2024, 10, 1)) for r in ids], schemas.TRIP)

    sinks.write_by_month(trips(["r1", "r2", "r2"]), cleaned)
    streaming.start_incremental_trip_load(spark, cleaned, table, ckpt).awaitTermination()
    sinks.write_by_month(trips(["r2", "r3"]), cleaned)
    streaming.start_incremental_trip_load(spark, cleaned, table, ckpt).awaitTermination()
    streaming.start_incremental_trip_load(spark, cleaned, table, ckpt).awaitTermination()  # nothing new
    loaded = spark.read.parquet(table)
    assert sorted(r.ride_id for r in loaded.collect()) == ["r1", "r2", "r3"]
    rejected = spark.read.parquet(table + "_rejected")
    assert rejected.count() == 2
    assert loaded.count() + rejected.count() == 5


def test_load_records_bad_files_and_loses_no_row(spark):
    root = tempfile.mkdtemp(prefix="tripflow-load2-")
    cleaned, table, ckpt = (os.path.join(root, p) for p in ("cleaned", "table", "ckpt"))
    # one task writes both months: its two files have the same name
    months = [(f"r{i % 3}", "b", T(2024, m, 1 + i), T(2024, m, 2 + i), "a", "1", "b", "2", None, None, None, None,
               "member", dt.date(2024, m, 1)) for m in (10, 11) for i in range(4)]
    months.append((None, *months[0][1:]))
    spark.createDataFrame(months, schemas.TRIP).coalesce(1).write.partitionBy("month").parquet(cleaned)
    with open(os.path.join(cleaned, "broken.parquet"), "w") as f:
        f.write("no")
    pq.write_table(pa.table({"ride_id": ["x"], "started_at": ["text"]}), os.path.join(cleaned, "narrow.parquet"))
    streaming.start_incremental_trip_load(spark, cleaned, table, ckpt).awaitTermination()
    assert rows(spark.read.parquet(table), "ride_id", "started_at") == [
        ("r0", T(2024, 10, 1)), ("r1", T(2024, 10, 2)), ("r2", T(2024, 10, 3))]
    rejected = spark.read.parquet(table + "_rejected").groupBy("reason").count()
    assert rows(rejected) == [("duplicate_ride_id", 5), ("null_ride_id", 1)]
    failed = {r.file_name: r.error_message for r in spark.read.parquet(table + "_failed").collect()}
    assert set(failed) == {"broken.parquet", "narrow.parquet"} and "missing columns" in failed["narrow.parquet"]


def test_feed_history_stream_quarantines_rows_without_time(spark):
    root = tempfile.mkdtemp(prefix="tripflow-hist-")
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    doc = '{"data":{"stations":[{"station_id":"a","last_reported":1727769600},{"station_id":"b"}]}}'
    with open(os.path.join(landing, "station_status_20241001080000.json"), "w") as f:
        f.write(doc)
    from tripflow.sources import feeds as feed_src
    snaps = feed_src.stream_snapshots(spark, landing)
    out = os.path.join(root, "history")
    streaming.start_feed_history(snaps, out, os.path.join(root, "ckpt"), available_now=True).awaitTermination()
    hist = spark.read.parquet(out)
    assert [r.station_id for r in hist.collect()] == ["a"]
    assert hist.first().inserted_at == T(2024, 10, 1, 8)
    assert [r.station_id for r in spark.read.parquet(out + "_quarantine").collect()] == ["b"]
    assert hist.filter(F.col("is_renting")).count() == 0
