import datetime as dt
import json

from conftest import rows
from tripflow.operators import feeds

T = dt.datetime


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "snap long, doc string")


def test_station_objects_edge_documents(spark):
    d = docs(spark, [
        json.dumps({"data": {"stations": [{"station_id": "a"}, {"station_id": "b"}]}}),
        json.dumps({"data": {"stations": []}}),
        json.dumps({"last_updated": 1}),  # no data
        "not json",
        None,
    ])
    out = feeds.station_objects(d, keep=("snap",))
    assert rows(out, "snap") == [(0,), (0,)]


def test_status_rows_flags_and_times(spark):
    st = [
        {"station_id": "a", "num_bikes_available": 3, "num_docks_available": 4, "is_installed": 1,
         "is_renting": 0, "is_returning": True, "last_reported": 1727769600},
        {"station_id": "b", "is_installed": None, "is_renting": "1", "last_reported": 1727769660},
        {"station_id": "c", "num_bikes_available": 2**40},  # overflow, no time
    ]
    d = docs(spark, [json.dumps({"data": {"stations": st}})])
    out = feeds.status_rows(feeds.station_objects(d), inserted_at="2024-10-01 08:00:00")
    got = {r.station_id: r for r in out.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.is_installed, a.is_renting, a.is_returning) == (True, False, True)
    assert a.last_reported == T(2024, 10, 1, 8, 0)
    assert (b.is_installed, b.is_renting, b.is_returning) == (False, True, False)
    assert c.num_bikes_available is None and c.last_reported is None
    reasons = dict(rows(out.select("station_id", feeds.status_defects().alias("r"))))
    assert reasons == {"a": None, "b": None, "c": "no_last_reported"}


def test_info_rows_absent_vs_null(spark):
    st = [
        {"station_id": "absent", "name": "x"},
        {"station_id": "null", "name": "y", "has_kiosk": None, "installed": None},
        {"station_id": "set", "name": "z", "has_kiosk": True, "eightd_has_key_dispenser": True},
    ]
    d = docs(spark, [json.dumps({"data": {"stations": st}})])
    out = feeds.info_rows(feeds.station_objects(d), as_of="2024-10-01 00:00:00")
    got = {r.station_id: r for r in out.collect()}
    assert got["absent"].has_kiosk is False and got["absent"].installed is False
    assert got["null"].has_kiosk is None and got["null"].installed is None
    assert got["set"].has_kiosk is True and got["set"].eightd_has_key_dispenser is True
    assert got["set"].last_reported == T(2024, 10, 1)


def test_parse_status_messages_edge_rows(spark):
    msgs = spark.createDataFrame([
        ('{"station_id":"a","num_bikes_available":1,"num_docks_available":2,"last_reported":1727769600}',),
        ("malformed {",),
        (None,),
        ('{"station_id":"b","num_bikes_available":"many","extra":1,"last_reported":1727769600}',),
        ('{"station_id":"c","num_bikes_available":99999999999,"last_reported":1727769600}',),
    ], "value string")
    out = feeds.parse_status_messages(msgs)
    got = rows(out)
    assert (None, None, None, None) in got
    by = {r[0]: r for r in got if r[0]}
    assert by["a"] == ("a", 1, 2, T(2024, 10, 1, 8))
    assert by["b"][1] is None and by["b"][3] == T(2024, 10, 1, 8)
    assert by["c"][1] is None
    assert len(got) == 5


def test_message_round_trip(spark):
    status = spark.createDataFrame(
        [("a", 1, 2, True, True, True, T(2024, 10, 1, 8, 0, 5, 123456), None)],
        "station_id string, num_bikes_available int, num_docks_available int, is_installed boolean,"
        " is_renting boolean, is_returning boolean, last_reported timestamp_ntz, inserted_at timestamp_ntz")
    back = feeds.parse_status_messages(feeds.to_status_messages(status))
    assert rows(back) == [("a", 1, 2, T(2024, 10, 1, 8, 0, 5))]


def test_millisecond_unit(spark):
    msgs = spark.createDataFrame([('{"station_id":"a","last_reported":1727769600000}',)], "value string")
    assert feeds.parse_status_messages(msgs, unit="ms").first().last_reported == T(2024, 10, 1, 8)
