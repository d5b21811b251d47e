import io
import json
import os
import tempfile
import zipfile

from conftest import rows
from pyspark.sql import functions as F
from tripflow import functions as tf
from tripflow import schemas
from tripflow.operators import clean
from tripflow.sources import feeds as feed_src
from tripflow.sources import trips as trip_src

H = ",".join(schemas.TRIP_CSV_COLUMNS)


def csv_text(n, start=0, header=H, quoted_newline=False):
    out = [header]
    for i in range(start, start + n):
        name = '"Pier\n40"' if quoted_newline and i == start else f"St {i}"
        out.append(f"R{i},classic_bike,2024-10-0{1 + i % 9} 08:00:00,2024-10-0{1 + i % 9} 09:00:00,"
                   f"{name},{i}.10,E {i},{i}.20,40.1,-73.1,40.2,-73.2,member")
    return "\n".join(out) + "\n"


def make_zip(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in entries.items():
            z.writestr(name, data)


def test_zip_records_nested_and_selection(spark):
    root = tempfile.mkdtemp(prefix="tripflow-zip-")
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("202410-demo-tripdata_2.csv", csv_text(40, start=100))
    make_zip(os.path.join(root, "202410-demo-tripdata.zip"), {
        "202410-demo-tripdata_1.csv": csv_text(50, quoted_newline=True),
        "202410-demo-tripdata_2.csv.zip": inner.getvalue(),
        "__MACOSX/._junk.csv": "x",
    })
    make_zip(os.path.join(root, "notes.zip"), {"a.csv": csv_text(5)})  # name outside the pattern
    make_zip(os.path.join(root, "202411-demo-tripdata.zip"), {"h.csv": H + "\n"})  # header only, tiny
    os.makedirs(os.path.join(root, "sub"))
    make_zip(os.path.join(root, "sub", "202411-demo-tripdata.csv.zip"), {"x.csv": csv_text(30, start=500)})
    listed = trip_src.list_archives(spark, root, tf.TRIP_ARCHIVE_PATTERN, 1000)
    names = sorted(os.path.basename(r.path) for r in listed.collect())
    assert names == ["202410-demo-tripdata.zip", "202411-demo-tripdata.csv.zip"]
    recs = trip_src.zip_records(spark, root, tf.TRIP_ARCHIVE_PATTERN, 1000, spread=4)
    assert trip_src.zip_records(spark, root).count() == 50 + 40 + 30 + 5  # by default no archive is left out
    assert recs.count() == 50 + 40 + 30
    kept, bad = clean.clean_trips(recs)
    assert kept.count() == 120 and bad.count() == 0
    assert kept.filter("ride_id = 'R0'").first().start_station_name == "Pier\n40"


def test_csv_records_binds_each_files_header(spark):
    root = tempfile.mkdtemp(prefix="tripflow-csv-")
    cols = list(reversed(schemas.TRIP_CSV_COLUMNS))
    with open(os.path.join(root, "a.csv"), "w") as f:
        f.write(csv_text(10))
    with open(os.path.join(root, "b.csv"), "w") as f:
        f.write(",".join(f'"{c}"' for c in cols) + "\n")
        f.write(",".join(["member", "-73.2", "40.2", "-73.1", "40.1", "9.20", "E 9", "9.10", "St 9",
                          "2024-10-02 09:00:00", "2024-10-02 08:00:00", "classic_bike", "RB"]) + "\n")
    recs = trip_src.csv_records(spark, root)
    kept, bad = clean.clean_trips(recs)
    assert kept.count() == 11 and bad.count() == 0
    rb = kept.filter("ride_id = 'RB'").first()
    assert rb.member_casual == "member" and rb.start_station_id == "9.10"


def test_feed_snapshots_time_from_name(spark):
    root = tempfile.mkdtemp(prefix="tripflow-feed-")
    for stamp, n in (("20241001080000", 2), ("20241001080100", 3)):
        doc = {"data": {"stations": [{"station_id": str(i), "last_reported": 1727769600} for i in range(n)]}}
        with open(os.path.join(root, f"station_status_{stamp}.json"), "w") as f:
            json.dump(doc, f, indent=4)
    snaps = feed_src.read_snapshots(spark, root)
    got = rows(snaps, "snapshot_time")
    assert [str(t[0]) for t in got] == ["2024-10-01 08:00:00", "2024-10-01 08:01:00"]
    from tripflow.operators import feeds
    assert feeds.station_objects(snaps).count() == 5


def test_csv_records_fallback_join_same_rows(spark):
    root = tempfile.mkdtemp(prefix="tripflow-csv2-")
    for name, start in (("a.csv", 0), ("b.csv", 100)):
        with open(os.path.join(root, name), "w") as f:
            f.write(csv_text(7, start=start))
    small = trip_src.csv_records(spark, root)
    big = trip_src.csv_records(spark, root, max_header_bytes=0)
    assert rows(small, "source", "line") == rows(big, "source", "line")
    assert small.count() == 14


def test_wide_records_and_unusual_files_lose_nothing(spark):
    root = tempfile.mkdtemp(prefix="tripflow-wide-")
    wide = [f"x{i}" for i in range(20)] + schemas.TRIP_CSV_COLUMNS
    cells = ["R1", "classic_bike", "2024-10-02 08:00:00", "2024-10-02 09:00:00", '"St, ""9"""', "9.10", "E", "9.20",
             "40.1", "-73.1", "40.2", "-73.2", "member"]
    with open(os.path.join(root, "a.csv"), "w") as f:  # 33 columns; the header again; separators only
        f.write("\n".join([",".join(wide), ",".join(["z"] * 20 + cells), ",".join(wide), "," * 32]) + "\n")
    with open(os.path.join(root, "b.csv"), "w") as f:  # no ride_id column at all
        f.write(",".join(schemas.TRIP_CSV_COLUMNS[1:]) + "\n" + ",".join(cells[1:]) + "\n")
    kept, bad = clean.clean_trips(trip_src.csv_records(spark, root))
    assert sorted((r.ride_id, r.start_station_name) for r in kept.collect()) == [
        ("R1", 'St, "9"'), ("unknown", 'St, "9"')]
    assert bad.count() == 2


def test_one_bad_csv_does_not_drop_its_archive(spark):
    root = tempfile.mkdtemp(prefix="tripflow-badcsv-")
    make_zip(os.path.join(root, "x.zip"), {"good.csv": csv_text(5), "bad.csv": b"ride_id\n\xff\xfe\xff\n",
                                           "last.csv": csv_text(4, start=50)})
    recs = trip_src.zip_records(spark, root)
    assert recs.filter("error is null").count() == 9
    assert [r.entry for r in recs.filter("error is not null").collect()] == ["bad.csv"]


def _broken_archive(root):
    """Six entries of several compressions behind leading bytes; the last bytes
    of one large entry's content are not those of its checksum."""
    path = os.path.join(root, "x.zip")
    methods = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)
    with zipfile.ZipFile(path, "w") as z:
        for i in range(5):
            z.writestr(f"m{i}.csv", csv_text(20, start=1000 * i), compress_type=methods[i % 4])
        z.writestr("broken.csv", csv_text(12_000, start=100_000))
    with open(path, "rb") as f:
        data = bytearray(f.read())
    at = data.rindex(b",member\n")
    data[at + 1:at + 7] = b"MEMBER"
    with open(path, "wb") as f:
        f.write(b"leading bytes" + data)


def test_entries_of_one_archive_are_dealt_and_whole(spark):
    root = tempfile.mkdtemp(prefix="tripflow-entries-")
    _broken_archive(root)
    entries = trip_src.archive_entries(trip_src.list_archives(spark, root))
    assert sorted(r.member for r in entries.collect()) == ["broken.csv", *(f"m{i}.csv" for i in range(5))]
    assert trip_src.entry_tasks(entries) == 4  # cores of the session
    assert trip_src.entry_tasks(entries.withColumn("compressed", F.lit(1 << 30))) == 6
    assert trip_src.entry_tasks(entries.limit(0)) == 1
    records = trip_src.entry_records(entries.coalesce(1), 6)
    tasks = records.select("entry", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == 6 and len({r.task for r in tasks}) == 6
    # records before the fault are given, then the error; whole_entries takes them away
    assert records.filter("entry = 'broken.csv' and error is null").count() == 10_000
    whole = trip_src.whole_entries(records, records.filter("error is not null"))
    assert rows(whole.groupBy("entry").count()) == [(f"m{i}.csv", 20) for i in range(5)]
    given = trip_src.zip_records(spark, root)
    assert [(r.entry, "CRC" in r.error) for r in given.filter("error is not null").collect()] == [("broken.csv", True)]
    assert given.count() == 101


def test_unreadable_archives_and_nested_entries(spark):
    root = tempfile.mkdtemp(prefix="tripflow-nested-")
    with open(os.path.join(root, "cut.zip"), "wb") as f:
        f.write(b"PK\x03\x04" + b"\x00" * 500)
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("good.csv", csv_text(3))
        z.writestr("bad.csv", b"ride_id\n\xff\xfe\n")
        deeper = io.BytesIO()
        with zipfile.ZipFile(deeper, "w") as y:
            y.writestr("deep.csv", csv_text(2, start=50))
        z.writestr("deeper.csv.zip", deeper.getvalue())
    make_zip(os.path.join(root, "n.zip"), {"a.csv.zip": inner.getvalue(), "b.csv.zip": b"not a zip", "empty.csv": ""})
    got = trip_src.zip_records(spark, root)
    ok = got.filter("error is null").groupBy("entry").count()
    assert rows(ok) == [("a.csv.zip!deeper.csv.zip!deep.csv", 2), ("a.csv.zip!good.csv", 3)]
    failed = got.filter("error is not null").select(tf.base_name("source").alias("f"), "entry")
    assert set(rows(failed)) == {("cut.zip", None), ("n.zip", "a.csv.zip!bad.csv"), ("n.zip", "b.csv.zip")}


def test_no_archives_at_all(spark):
    root = tempfile.mkdtemp(prefix="tripflow-none-")
    assert trip_src.zip_records(spark, root).count() == 0
