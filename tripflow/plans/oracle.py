"""The stand-in mappings of :mod:`tripflow.plans.standins` as plain SQL, and
SQL building blocks for the oracle queries in ``__spark_entry__``.

Run by DuckDB over the same Parquet tables; never used by the Spark jobs.
"""

from __future__ import annotations

from tripflow import schemas

STATUS = """
  SELECT CAST(user_id AS VARCHAR) AS station_id,
         CAST(floor(value) AS INTEGER) AS num_bikes_available,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_docks_available,
         event_type <> 'signup' AS is_installed,
         event_type <> 'error' AS is_renting,
         event_type <> 'purchase' AS is_returning,
         ts AS last_reported,
         ts AS inserted_at
  FROM events"""

INFO = """
  SELECT CAST(c_custkey AS VARCHAR) AS station_id,
         c_name AS name,
         CAST(c_custkey AS VARCHAR) || '.10' AS short_name,
         c_acctbal / 100 AS lat,
         CAST(c_nationkey AS DOUBLE) AS lon,
         c_mktsegment AS region_id,
         CAST(c_nationkey AS INTEGER) AS capacity,
         FALSE AS eightd_has_key_dispenser,
         c_acctbal >= 0 AS has_kiosk,
         TRUE AS installed,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS last_reported,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer"""

TRIPS = """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ride_id,
         CASE l_returnflag WHEN 'A' THEN 'classic_bike' WHEN 'N' THEN 'electric_bike'
              ELSE 'docked_bike' END AS rideable_type,
         l_shipdate AS started_at,
         l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) AS ended_at,
         'Station ' || CAST(l_suppkey AS VARCHAR) AS start_station_name,
         CAST(l_suppkey AS VARCHAR) || '.10' AS start_station_id,
         'Station ' || CAST(l_partkey AS VARCHAR) AS end_station_name,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) || '.10' END AS end_station_id,
         TRY_CAST(l_extendedprice / 1000 AS DECIMAL(9,6)) AS start_lat,
         TRY_CAST(-l_discount AS DECIMAL(9,6)) AS start_lng,
         TRY_CAST(l_tax AS DECIMAL(9,6)) AS end_lat,
         TRY_CAST(l_quantity AS DECIMAL(9,6)) AS end_lng,
         CASE WHEN l_linestatus = 'O' THEN 'member' ELSE 'casual' END AS member_casual,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month
  FROM lineitem"""

_KEYS = ", ".join(f"s.{k}" if k in ("station_id", *schemas.STATUS_FLAGS) else f"i.{k}"
                  for k in schemas.STATION_KEYS)

STATION_AGG = f"""
  SELECT {_KEYS},
         avg(s.num_bikes_available) AS avg_bikes_available,
         avg(s.num_docks_available) AS avg_docks_available,
         max(s.last_reported) AS status_last_reported,
         max(i.last_reported) AS info_last_reported,
         CAST(max(s.last_reported) AS DATE) AS aggregation_date
  FROM status s JOIN info i ON s.station_id = i.station_id
  GROUP BY {_KEYS}"""

STATION_LATEST = """
  SELECT * FROM agg
  QUALIFY row_number() OVER (
    PARTITION BY station_id
    ORDER BY status_last_reported DESC NULLS LAST, is_installed DESC NULLS LAST,
             is_renting DESC NULLS LAST, is_returning DESC NULLS LAST,
             name DESC NULLS LAST, short_name DESC NULLS LAST) = 1"""


def with_(**ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` from keyword arguments, in order."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())


def enrich_select(station_view: str) -> str:
    trip_cols = []
    for c in schemas.TRIP_COLUMNS:
        new = schemas.TRIP_RENAMES.get(c)
        trip_cols.append(f"t.{c} AS {new}" if new else f"t.{c}")
    st = []
    for alias, prefix in (("s", "start"), ("e", "end")):
        for src, suffix in schemas.ENRICH_STATION_COLUMNS:
            st.append(f"{alias}.{src} AS {prefix}_{suffix}")
    return (
        f"SELECT {', '.join(trip_cols)}, {', '.join(st)}\n"
        f"  FROM trips t\n"
        f"  LEFT JOIN {station_view} s ON t.start_station_id = s.short_name\n"
        f"  LEFT JOIN {station_view} e ON t.end_station_id = e.short_name"
    )
