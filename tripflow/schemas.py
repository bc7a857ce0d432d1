"""Declared schemas and fixed values of the trip model."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def declared(columns: str) -> T.StructType:
    """Schema from `name type, ..` with simple types; unlike `fromDDL` it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: feed column lists and types ---
GREEN_FEED = declared("""
    VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int,
    passenger_count int, trip_distance double, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double,
    total_amount double, payment_type int, trip_type int, congestion_surcharge double
""")
YELLOW_FEED = declared("""
    VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double
""")
HIRE_FEED = declared("""
    hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp,
    dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string
""")
ZONES = declared("locationid int, borough string, zone string, service_zone string")
PAYMENT_TYPES = declared("payment_type int, description string")
RIDE_EVENT = declared("""
    PULocationID int, DOLocationID int, trip_distance double, total_amount double,
    tpep_pickup_datetime bigint
""")
GREEN_EVENT = declared("""
    lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int, DOLocationID int,
    passenger_count double, trip_distance double, tip_amount double, total_amount double
""")
SCORED_TRIPS = declared("""
    VendorID int, lpep_pickup_datetime timestamp, PULocationID int, DOLocationID int,
    trip_distance double, predicted_duration double
""")

# --- fixed values: payment codes and vendor names ---
PAYMENT_TYPE_ROWS = [
    (0, "Unknown"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

# --- fixed values: text standing for NULL in a surrogate key, name of the union's source column ---
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SOURCE_COLUMN = "_dbt_source_relation"

# Exact type of money and distances in the staged model: nine digits after the point, as in the source
# model's 38-digit numeric. 18 digits stay long-backed in Tungsten rows; amounts of a thousand
# million and more are an error, and `stage_trips(numeric=..)` takes a wider type.
NUMERIC = "decimal(18,9)"

# Measures summed by the monthly reports, in output order.
MONEY_COLUMNS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "congestion_surcharge", "improvement_surcharge", "total_amount",
]
