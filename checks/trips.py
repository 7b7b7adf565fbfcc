"""The trips view: raw trip records derived from every row of ``lineitem``.

``h`` spreads defects over the rows: reversed times, impossible distances,
unknown zones and payment codes, negative fares, missing passenger counts.
Every row with ``h % 50 = 0`` appears twice. A smaller defect period makes a
dirtier feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HASH = (
    "(l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709"
    " + l_linenumber * 15485863) % 1000003"
)

_START = "{ts} '2026-06-01 00:00:00'"
_PICKUP = "(l_orderkey % 7) * 86400 + h % 86400"
_LENGTH = "(120 + CAST(l_quantity AS BIGINT) * 45 + (l_partkey * 13 + l_orderkey) % 600)"
_FARE = "(CAST(floor(l_extendedprice / 250) AS DOUBLE) / 4)"
_SIGN = "(CASE WHEN h % {period} = 8 THEN -1 ELSE 1 END)"

COLUMNS = {
    "VendorID": "CAST(l_linenumber % 2 + 1 AS INT)",
    "tpep_pickup_datetime": f"{_START} + ({_PICKUP}) * INTERVAL '1' SECOND",
    "tpep_dropoff_datetime": f"{_START} + ({_PICKUP}"
    f" + (CASE WHEN h % {{period}} = 0 THEN -1 ELSE 1 END) * {_LENGTH}) * INTERVAL '1' SECOND",
    "passenger_count": "CAST(CASE WHEN h % 150 = 1 THEN NULL ELSE 1 + h % 6 END AS BIGINT)",
    "trip_distance": "CASE WHEN h % {period} = 2 THEN l_quantity * 1000 ELSE l_quantity / 4 END",
    "RatecodeID": "CAST(CASE h % 20 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN NULL"
    " WHEN 3 THEN 5 ELSE 1 END AS BIGINT)",
    "store_and_fwd_flag": "CASE WHEN h % 50 = 0 THEN ' y ' ELSE 'N' END",
    "PULocationID": "CAST(CASE WHEN h % {period} = 4 THEN 999 ELSE 1 + l_partkey % 265 END AS INT)",
    "DOLocationID": "CAST(1 + (l_orderkey + l_suppkey) % 265 AS INT)",
    "payment_type": "CAST(CASE WHEN h % {period} = 6 THEN 99 ELSE 1 + h % 4 END AS BIGINT)",
    "fare_amount": f"{_SIGN} * {_FARE}",
    "extra": "CAST(0.5 AS DOUBLE)",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "CASE WHEN h % 4 = 0 THEN CAST(floor(l_extendedprice / 2000) AS DOUBLE) / 4"
    " ELSE CAST(0 AS DOUBLE) END",
    "tolls_amount": "CAST(0 AS DOUBLE)",
    "improvement_surcharge": "CAST(0.25 AS DOUBLE)",
    "total_amount": f"{_SIGN} * ({_FARE} + CAST(3.25 AS DOUBLE))",
    "congestion_surcharge": "CAST(2.5 AS DOUBLE)",
    "airport_fee": "CASE WHEN h % 20 IN (0, 1) THEN CAST(1.75 AS DOUBLE)"
    " ELSE CAST(0 AS DOUBLE) END",
}

CLEAN_FEED = 200
DIRTY_FEED = 20


def expressions(ts: str, period: int) -> list[str]:
    return [f"{sql.format(ts=ts, period=period)} AS {name}" for name, sql in COLUMNS.items()]


def trips(spark: SparkSession, sf_dir: str, *, period: int = CLEAN_FEED) -> DataFrame:
    """The view in Spark; times are ``timestamp_ntz``."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = rows.selectExpr("*", f"{HASH} AS h")
    # Built as one struct per row and then repeated: filters on trip columns
    # stay above the generator instead of being inlined into its expressions.
    trip = f"struct({', '.join(expressions('TIMESTAMP_NTZ', period))}) AS trip"
    copies = "inline(array_repeat(trip, CASE WHEN h % 50 = 0 THEN 2 ELSE 1 END))"
    return rows.selectExpr("h", trip).selectExpr(copies)


def trips_sql(period: int = CLEAN_FEED) -> str:
    """The same view as a sub-select for the SQL oracle."""
    return (
        f"SELECT {', '.join(expressions('TIMESTAMP', period))}\n"
        f"FROM (SELECT *, UNNEST(CASE WHEN h % 50 = 0 THEN [1, 2] ELSE [1] END) AS copy\n"
        f"      FROM (SELECT *, {HASH} AS h FROM lineitem))"
    )
