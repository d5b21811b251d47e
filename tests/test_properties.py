"""Operators against brute-force Python on random inputs (nulls, repeated
and hot keys)."""

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tripflow import schemas
from tripflow.operators import enrich, stations, tables

T0 = dt.datetime(2024, 10, 1)
SIDS = st.sampled_from(["a", "a", "a", "b", "c", None])  # "a" is hot
FLAG = st.sampled_from([True, False, None])
NUM = st.one_of(st.none(), st.integers(0, 40))

status_rows = st.lists(st.tuples(SIDS, NUM, NUM, FLAG, FLAG, st.integers(0, 10_000)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(status_rows, st.sets(st.sampled_from(["a", "b", "d"]), min_size=1))
def test_station_aggregate_brute_force(spark, rows_, info_ids):
    status = spark.createDataFrame(
        [(s, b, d, True, r, ret, T0 + dt.timedelta(minutes=m), None) for s, b, d, r, ret, m in rows_],
        schemas.STATION_STATUS)
    info = spark.createDataFrame(
        [(i, "N" + i, i + ".1", 1.0, 2.0, None, 3, False, True, True, T0, T0, T0) for i in info_ids],
        schemas.STATION_INFORMATION)
    got = {(r.station_id, r.is_renting, r.is_returning): (r.avg_bikes_available, r.avg_docks_available,
                                                           r.status_last_reported)
           for r in stations.station_aggregate(status, info).collect()}
    groups = defaultdict(list)
    for s, b, d, r, ret, m in rows_:
        if s in info_ids:
            groups[(s, r, ret)].append((b, d, T0 + dt.timedelta(minutes=m)))

    def avg(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    want = {k: (avg([v[0] for v in vs]), avg([v[1] for v in vs]), max(v[2] for v in vs))
            for k, vs in groups.items()}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z", None]), st.sampled_from(["x", "y", "w", None])),
                min_size=1, max_size=30),
       st.lists(st.sampled_from(["x", "x", "y", "q"]), max_size=6))
def test_enrich_multiplicity_brute_force(spark, trips_, shorts):
    trips = spark.createDataFrame(
        [(f"r{i}", "b", T0, T0, "s", s, "e", e, None, None, None, None, "m", T0.date())
         for i, (s, e) in enumerate(trips_)], schemas.TRIP)
    st_rows = [(f"id{i}", f"n{i}", sh, None, 1.0, 2.0, 3, True, True, True, True, True, 1.0, 1.0, T0, T0,
                T0.date()) for i, sh in enumerate(shorts)]
    stations_df = spark.createDataFrame(st_rows, schemas.STATION_STATUS_TRANSFORMED)
    out = enrich.enrich_trips(trips, stations_df)
    n = {sh: shorts.count(sh) for sh in set(shorts)}
    want = sum(max(1, n.get(s, 0)) * max(1, n.get(e, 0)) for s, e in trips_)
    assert out.count() == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k1", "k1", "k2", "k3", "k4"]), st.integers(0, 5)),
                min_size=1, max_size=30),
       st.sets(st.sampled_from(["k1", "k3", "k9"])))
def test_insert_if_absent_brute_force(spark, incoming_, target_keys):
    incoming = spark.createDataFrame(incoming_, "ride_id string, v int")
    target = spark.createDataFrame([(k,) for k in sorted(target_keys)], "ride_id string")
    for bound in (10_000, 0):
        got = sorted(tuple(r) for r in tables.insert_if_absent(incoming, target, ["ride_id"], ["v"],
                                                               max_broadcast_bytes=bound).collect())
        want = sorted((k, min(v for kk, v in incoming_ if kk == k))
                      for k in {k for k, _ in incoming_} if k not in target_keys)
        assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9), st.integers(0, 3)),
                max_size=12))
def test_upsert_brute_force(spark, updates_):
    VALUES = ["name", "short_name", "lat", "lon", "region_id", "capacity",
              "eightd_has_key_dispenser", "has_kiosk", "installed", "last_reported"]

    def info_row(sid, cap, day):
        return (sid, "n", "s", 1.0, 2.0, "r", cap, False, True, True, T0 + dt.timedelta(days=day), T0, T0)

    existing = spark.createDataFrame([info_row("a", 100, 0), info_row("z", 100, 0)], schemas.STATION_INFORMATION)
    updates = spark.createDataFrame([info_row(s, c, d) for s, c, d in updates_], schemas.STATION_INFORMATION)
    out = {r.station_id: r for r in tables.upsert(existing, updates, "station_id", VALUES,
                                                  version="last_reported", as_of="2025-01-01 00:00:00").collect()}
    want = {"a": 100, "z": 100}
    latest = {}
    for s, c, d in updates_:
        if s not in latest or (d, c) > latest[s]:
            latest[s] = (d, c)
    for s, (d, c) in latest.items():
        want[s] = c
    assert {k: r.capacity for k, r in out.items()} == want
    assert out["z"].updated_at == T0
