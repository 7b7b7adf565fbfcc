"""Declared layouts and fixed domain values of the trip warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

INT, BIGINT, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BOOLEAN = T.StringType(), T.BooleanType()
TIMESTAMP, DATE = T.TimestampType(), T.DateType()


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# --- Fixed values: column names, types and codes of the published trip feed ---

RAW_LAYOUT = _layout(
    ("VendorID", INT),
    ("tpep_pickup_datetime", TIMESTAMP),
    ("tpep_dropoff_datetime", TIMESTAMP),
    ("passenger_count", BIGINT),
    ("trip_distance", DOUBLE),
    ("RatecodeID", BIGINT),
    ("store_and_fwd_flag", STRING),
    ("PULocationID", INT),
    ("DOLocationID", INT),
    ("payment_type", BIGINT),
    ("fare_amount", DOUBLE),
    ("extra", DOUBLE),
    ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE),
    ("airport_fee", DOUBLE),
)

RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_at",
    "tpep_dropoff_datetime": "dropoff_at",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}

#: The stored column that a window of dates is about.
RAW_PICKUP = "tpep_pickup_datetime"

TRIP_KEY = (
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "pu_location_id",
    "do_location_id",
    "trip_distance",
    "fare_amount",
    "total_amount",
)
KEY_SEPARATOR = "|"
KEY_NULL = "<null>"

PARTITION = "pickup_date"
GRAIN = (PARTITION, "pu_location_id")

PAYMENT_TYPES = (1, 2, 3, 4, 5, 6)
RATE_CODES = (1, 2, 3, 4, 5, 6)
AIRPORT_RATE_CODES = (2, 3)
LAST_ZONE = 265

# label, first hour, last hour
DAY_PARTS = (
    ("overnight", 0, 5),
    ("morning", 6, 11),
    ("afternoon", 12, 16),
    ("evening", 17, 21),
    ("night", 22, 23),
)

LONGEST_TRIP_MINUTES = 720
LONGEST_TRIP_MILES = 200.0
FASTEST_MPH = 90.0
LARGEST_FARE = 5000.0
LARGEST_TIP_PCT = 1000.0

GOLD_LAYOUT = T.StructType(
    [
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("trips", T.LongType(), nullable=False),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("avg_trip_distance", T.DoubleType()),
        T.StructField("avg_duration_min", T.DoubleType()),
        T.StructField("median_duration_min", T.DoubleType()),
        T.StructField("avg_tip_pct", T.DoubleType()),
        T.StructField("airport_trip_share", T.DoubleType()),
    ]
)

ENRICHED = _layout(
    ("trip_duration_min", DOUBLE),
    ("avg_speed_mph", DOUBLE),
    ("fare_per_mile", DOUBLE),
    ("tip_pct", DOUBLE),
    ("pickup_date", DATE),
    ("pickup_hour", INT),
    ("pickup_day_of_week", INT),
    ("time_of_day", STRING),
    ("is_airport_trip", BOOLEAN),
)

# --- End of fixed values ---

BRONZE_LAYOUT = T.StructType(
    [T.StructField(RENAMES.get(f.name, f.name), f.dataType) for f in RAW_LAYOUT]
    + [T.StructField("trip_id", T.StringType()), T.StructField(PARTITION, T.DateType())]
)

SILVER_LAYOUT = T.StructType(
    [f for f in BRONZE_LAYOUT if f.name != PARTITION] + list(ENRICHED.fields)
)

LAYERS = {"bronze": BRONZE_LAYOUT, "silver": SILVER_LAYOUT, "gold": GOLD_LAYOUT}
