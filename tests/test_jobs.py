"""End to end: archives -> clean -> load -> station transform -> enrichment,
and the metadata upsert, on small hand-made inputs."""

import datetime as dt
import json
import os
import tempfile
import zipfile

from tripflow import schemas, sinks
from tripflow.plans import jobs

H = ",".join(schemas.TRIP_CSV_COLUMNS)
T = dt.datetime


def trip_csv(ids, month="10"):
    out = [H]
    for i in ids:
        out.append(f"R{i},classic_bike,2024-{month}-05 08:00:00,2024-{month}-05 09:00:00,"
                   f"St {i},{i % 3}.10,E {i},{(i + 1) % 3}.10,40.1,-73.1,40.2,-73.2,member")
    out.append("BAD,classic_bike,not a time,2024-10-05 09:00:00,a,1,b,2,40.1,-73.1,40.2,-73.2,member")
    return "\n".join(out) + "\n"


def test_archive_to_enriched_trips(spark):
    root = tempfile.mkdtemp(prefix="tripflow-e2e-")
    arch = os.path.join(root, "archives")
    os.makedirs(arch)
    with zipfile.ZipFile(os.path.join(arch, "202410-demo-tripdata.zip"), "w") as z:
        z.writestr("202410-demo-tripdata.csv", trip_csv(range(0, 60)))
    with zipfile.ZipFile(os.path.join(arch, "202411-demo-tripdata.zip"), "w") as z:
        z.writestr("202411-demo-tripdata.csv", trip_csv(range(50, 80), month="11"))  # 10 repeats
    with open(os.path.join(arch, "202412-demo-tripdata.zip"), "wb") as f:
        f.write(b"PK\x03\x04" + b"\x00" * 2000)  # corrupt
    with zipfile.ZipFile(os.path.join(arch, "202409-demo-tripdata.zip"), "w") as z:
        z.writestr("202409-demo-tripdata.csv", H + "\n" + " " * 1200)  # header only
    p = {k: os.path.join(root, k) for k in ("cleaned", "quarantine", "manifest", "table", "ckpt",
                                             "transformed", "enriched")}
    counts = jobs.clean_trip_archives(spark, arch, p["cleaned"], p["quarantine"], p["manifest"],
                                      as_of="2024-12-01 00:00:00")
    by = {r.file_name: (r.rows, r.kept, r.quarantined) for r in counts.collect()}
    assert by == {"202410-demo-tripdata.zip": (61, 60, 1), "202411-demo-tripdata.zip": (31, 30, 1),
                  "202409-demo-tripdata.zip": (0, 0, 0)}
    failed = spark.read.parquet(p["manifest"] + "_failed").collect()
    assert [r.file_name for r in failed] == ["202412-demo-tripdata.zip"]
    # a second run finds nothing new
    assert jobs.clean_trip_archives(spark, arch, p["cleaned"], p["quarantine"], p["manifest"]).count() == 0
    # a re-run whose manifest write was lost rewrites each archive's rows in place
    jobs.clean_trip_archives(spark, arch, p["cleaned"], p["quarantine"], p["manifest"] + "_lost")
    assert spark.read.parquet(p["cleaned"]).count() == 90
    assert spark.read.parquet(p["quarantine"]).count() == 2

    table = jobs.load_trips(spark, p["cleaned"], p["table"], p["ckpt"])
    assert table.count() == 80  # R50..R59 loaded once
    assert jobs.load_trips(spark, p["cleaned"], p["table"], p["ckpt"]).count() == 80

    status = spark.createDataFrame(
        [(str(s), b, 5, True, True, True, T(2024, 10, 1, h), None)
         for s in range(3) for b, h in ((1, 8), (3, 9))], schemas.STATION_STATUS)
    info = spark.createDataFrame(
        [(str(s), f"Station {s}", f"{s}.10", 40.0, -73.0, "r", 10, False, True, True,
          T(2024, 9, 1), T(2024, 9, 1), T(2024, 9, 1)) for s in range(3)], schemas.STATION_INFORMATION)
    assert jobs.transform_stations(spark, status, info, p["transformed"]) == 3
    transformed = spark.read.schema(schemas.STATION_STATUS_TRANSFORMED).parquet(p["transformed"])
    jobs.enrich_trip_table(spark, table, transformed, p["enriched"])
    enriched = spark.read.parquet(p["enriched"])
    assert enriched.count() == 80
    r = enriched.filter("ride_id = 'R4'").first()
    assert r.start_station_short_name == "1.10" and r.end_station_name == "Station 2"
    assert r.start_avg_bikes_available == 2.0


def test_station_information_upsert_versions(spark):
    root = tempfile.mkdtemp(prefix="tripflow-info-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    os.makedirs(landing)

    def snap(stamp, stations):
        with open(os.path.join(landing, f"station_information_{stamp}.json"), "w") as f:
            json.dump({"data": {"stations": stations}}, f)

    ckpt = os.path.join(root, "ckpt")
    snap("20241001000000", [{"station_id": "a", "name": "A", "capacity": 5},
                            {"station_id": "b", "name": "B", "has_kiosk": None}])
    jobs.upsert_station_information(spark, landing, table, ckpt)
    snap("20241002000000", [{"station_id": "a", "name": "A2", "capacity": 6}])
    jobs.upsert_station_information(spark, landing, table, ckpt)
    jobs.upsert_station_information(spark, landing, table, ckpt)  # nothing new: no new version
    cur = {r.station_id: r for r in sinks.read_current(spark, table, schemas.STATION_INFORMATION).collect()}
    assert cur["a"].name == "A2" and cur["a"].capacity == 6
    assert cur["a"].created_at == T(2024, 10, 1) and cur["a"].updated_at == T(2024, 10, 2)
    assert cur["b"].has_kiosk is None and cur["b"].installed is False
    assert cur["b"].updated_at == T(2024, 10, 1)  # absent from the second snapshot: unchanged
    assert len(sinks.versions(spark, table)) == 2


def test_cli_stations_and_renting(spark, capsys):
    root = tempfile.mkdtemp(prefix="tripflow-cli-")
    history, info_table, out, renting = (os.path.join(root, p) for p in ("history", "info", "out", "renting"))
    spark.createDataFrame(
        [("a", 1, 2, True, r, True, T(2024, 10, d), None) for d, r in ((1, True), (2, False), (3, None))],
        schemas.STATION_STATUS).write.parquet(history)
    sinks.commit_version(spark.createDataFrame(
        [("a", "A", "a.1", 1.0, 2.0, "r", 5, False, True, True, T(2024, 9, 1), T(2024, 9, 1), T(2024, 9, 1))],
        schemas.STATION_INFORMATION), info_table)
    jobs.main(["stations", history, info_table, out])
    assert capsys.readouterr().out.strip().endswith("3")  # rows for renting true / false / null
    jobs.main(["renting", history, renting])
    got = spark.read.parquet(renting).collect()
    assert [(r.station_id, str(r.day)) for r in got] == [("a", "2024-10-01")]


def test_relational_places_read_and_appended(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tripflow-place-")
    status = spark.createDataFrame([("a", 1, 2, True, True, True, T(2024, 10, 1), None)], schemas.STATION_STATUS)
    info = spark.createDataFrame([("a", "A", "a.1", 1.0, 2.0, "r", 5, False, True, True, T(2024, 9, 1), T(2024, 9, 1),
                                   T(2024, 9, 1))], schemas.STATION_INFORMATION)
    held = {"status": status, "info": info}
    written = {}
    monkeypatch.setattr(jobs.relational, "read_table", lambda spark, url, table: held[table])
    monkeypatch.setattr(jobs.sinks, "write_jdbc", lambda df, url, table: written.update({(url, table): df.collect()}))
    url = "jdbc:demo://host/db"
    jobs.main(["stations", f"{url}#status", f"{url}#info", os.path.join(root, "out"), "--append-to", f"{url}#done"])
    assert [(r.station_id, r.avg_bikes_available) for r in written[(url, "done")]] == [("a", 1.0)]
