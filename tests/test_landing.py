import csv
import glob
import gzip
import io
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tripflow import sinks
from tripflow import functions as tf
from tripflow.operators import clean, metrics
from tripflow.plans import standins
from tripflow.sources import csv_text, spread_scan
from tripflow.sources import trips as trip_src


def lineitem(spark, folder, n=400):
    rows = [(i // 7, i, i % 5, i % 7, float(i % 50), 1000.0 + i, 0.1 if i % 11 == 0 else 0.05, 0.02, "ANR"[i % 3],
             "OF"[i % 2], datetime(1995 + i % 3, 1 + i % 2, 1 + i % 28) if i % 97 else None) for i in range(n)]
    table = spark.createDataFrame(
        rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
              " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
              " l_shipdate timestamp_ntz")
    table.write.parquet(f"file://{folder}/lineitem")
    return spark.read.parquet(f"file://{folder}/lineitem")


def landed(spark, table, path, glob_, **layout):
    standins.land_csv_files(table, path, **layout)
    return clean.clean_trips(trip_src.csv_records(spark, path, glob=glob_))


def test_a_larger_table_is_landed_as_more_files_each_with_its_header(spark, tmp_path, monkeypatch):
    table = lineitem(spark, tmp_path)
    kept, bad = landed(spark, table, f"file://{tmp_path}/few", "*.txt")
    few = glob.glob(f"{tmp_path}/few/*/*/*.txt")
    monkeypatch.setattr(standins, "MONTH_FILE_BYTES", standins.estimated_bytes(table) // 9)
    more_kept, more_bad = landed(spark, table, f"file://{tmp_path}/more", "*.txt")
    more = glob.glob(f"{tmp_path}/more/*/*/*.txt")
    assert len(more) > 2 * len(few)
    for name in more:
        with open(name) as f:
            assert "started_at" in f.readline()
            assert "started_at" not in f.read()
    expected = clean.split_clean(clean.type_trips(clean.bind_by_header(standins.raw_trip_records(table))))[0]
    assert kept.count() + bad.count() == more_kept.count() + more_bad.count() == 400
    assert sorted(kept.collect()) == sorted(more_kept.collect()) == sorted(expected.collect())


def test_wide_files_are_compressed_and_read_back(spark, tmp_path):
    table = lineitem(spark, tmp_path)
    kept, bad = landed(spark, table, f"file://{tmp_path}/wide", "*.txt*", extra=12, compression="gzip")
    names = glob.glob(f"{tmp_path}/wide/*/*/part-*")
    assert names and all(n.endswith(".txt.gz") for n in names)
    assert all(gzip.open(n, "rt").readline().count("extra_") == 12 for n in names)
    assert kept.count() + bad.count() == 400


def test_text_is_not_shuffled_where_csv_files_are_landed(spark, tmp_path, monkeypatch):
    seen = []
    render = standins.raw_trip_records
    monkeypatch.setattr(standins, "raw_trip_records", lambda rows, **more: seen.append(rows) or render(rows, **more))
    standins.land_csv_files(lineitem(spark, tmp_path, 20), f"file://{tmp_path}/t")
    assert "l_orderkey" in seen[0].columns and "line" not in seen[0].columns
    assert "RepartitionByExpression" in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_row_group_is_spread_over_tasks_of_a_bounded_size(spark, tmp_path):
    pq.write_table(pa.table({"k": list(range(50_000))}), f"{tmp_path}/t.parquet")  # one row group
    df = spark.read.parquet(f"file://{tmp_path}/t.parquet")
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert spread_scan(df, ["k"], task_bytes=size // 20).rdd.getNumPartitions() >= 20
    assert spread_scan(df, ["k"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_header_is_made_once_a_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x", y\n1,2\n3,4\n')
    got = csv_text.quoted_records(spark, f"file://{tmp_path}", "*.csv", header=clean.normalise_header)
    assert [tuple(r)[1:] for r in got.collect()] == [("x,y", "1,2"), ("x,y", "3,4")]
    plan = trip_src.csv_records(spark, f"file://{tmp_path}")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan.split("MapInArrow", 1)[0]


def test_base_name_of_paths(spark):
    paths = ["file:/a/b/c.zip", "c.zip", "a/", "", None]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(tf.base_name("p")).collect()
    assert [r[0] for r in got] == ["c.zip", "c.zip", "", "", None]


def test_places_of_a_file_are_counted_without_a_row_for_each(spark, tmp_path):
    rows = spark.range(70_000).select(F.lit("m").alias("month"), F.lit("f").alias("source_file"),
                                      (F.col("id") % 69_000).alias("source_row"))
    out = metrics.rows_per_file(rows)
    assert [tuple(r) for r in out.collect()] == [("m", "f", 70_000, 69_000)]
    assert "source_row" not in out._jdf.queryExecution().executedPlan().toString().split("keys=")[1].split("]")[0]


def test_files_of_a_folder_are_counted(spark, tmp_path):
    for n in "abc":
        (tmp_path / n).write_text(n)
    assert sinks.folder_files(spark, f"file://{tmp_path}") == 3


def test_landed_lines_are_those_of_a_csv_writer(spark, tmp_path):
    table = lineitem(spark, tmp_path).withColumn("l_orderkey", F.when(F.col("l_linenumber") != 6, F.col("l_orderkey")))
    for layout in ({}, {"extra": 12}, {"extra": 3, "without": ("ride_id",), "pier": ', "Old"\n\r\n,Pier'}):
        for source, header, line in standins.raw_trip_records(table, **layout).collect():
            fields = next(csv.reader(io.StringIO(line, newline="")))
            out = io.StringIO(newline="")
            csv.writer(out, lineterminator="").writerow(fields)
            cells = dict(zip(header.split(","), fields, strict=True))
            assert out.getvalue() == line and cells["start_station_name"].endswith(layout.get("pier", ", Pier"))
            ride = cells.get("ride_id")
            for i in range(layout.get("extra", 0)):
                if ride:
                    assert cells[f"extra_{i}"] == ("NA" if ride == "NA" else f'extra_{i}, "{ride}"')


def test_every_source_has_its_headers_in_each_file(spark, tmp_path):
    standins.land_csv_files(lineitem(spark, tmp_path), f"file://{tmp_path}/y", yearly=True)
    names = glob.glob(f"{tmp_path}/y/*/*/*.txt")
    assert len(names) == standins.SOURCE_FILES * 4  # 1995 to 1997, and rows without a time
    assert all(open(n).readline().startswith(("ride_id,", "member_casual,")) for n in names)
