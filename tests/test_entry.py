"""The driver contract: entry() runs, every query matches its oracle SQL on
the smallest test tables, and its plan is the one we want."""

import math
import re
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "station_id" and df.count() > 0


# the optional corpus operators have tests of their own
NAMES = sorted(n for n in E.queries() if n != "pipeline" and not re.match(r"(op|lm)\d+_", n))


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got, cols = df.collect(), df.columns
    rel = duck.sql(E.oracle_sql()[name])
    exp, ocols = rel.fetchall(), rel.columns
    assert sorted(cols) == sorted(ocols)

    def bag(c, rs):
        order = sorted(range(len(c)), key=lambda i: c[i])
        return Counter(tuple(norm(r[i]) for i in order) for r in rs)

    assert bag(cols, got) == bag(ocols, exp)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_month_filter_prunes_partitions(spark):
    df = E.queries()["month_partition_read"](spark, SF)
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(month" in plan and "1996-03-01" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(E.queries()["trips_per_day"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_enrich_plan_is_two_broadcast_joins(spark):
    plan = plan_of(E.queries()["trip_enrich_latest"](spark, SF))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan.split("InMemoryRelation")[0]


def test_station_aggregate_shuffles_history_once(spark):
    plan = plan_of(E.queries()["station_aggregate"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan
