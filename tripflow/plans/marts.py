"""Fact and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import minutes_between, surrogate_key, vendor_name
from ..operators.dedup import keep_first
from ..operators.joins import join_dimension_twice, lookup_with_default

TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]

# The first column orders duplicates; the others only break ties, so that runs agree.
DUPLICATE_ORDER = [
    "dropoff_datetime", "dropoff_location_id", "total_amount", "trip_distance", "fare_amount",
    "passenger_count", "tip_amount", "extra", "mta_tax", "rate_code_id", "payment_type",
    "tolls_amount", "store_and_fwd_flag",
]


def with_payment_text(trips: DataFrame, payment_types: DataFrame) -> DataFrame:
    return lookup_with_default(trips, payment_types, "payment_type", 0, "description", "Unknown",
                               "payment_type_description")


def first_trips(unioned: DataFrame) -> DataFrame:
    """One row per vendor, pickup second, zone and service."""
    return keep_first(unioned, TRIP_KEY, DUPLICATE_ORDER)


def unique_trips(unioned: DataFrame, payment_types: DataFrame) -> DataFrame:
    """The first trips with their key and payment text.

    Duplicates go first: the key is then hashed and the lookup joined for surviving rows only.
    """
    first = first_trips(unioned)
    return with_payment_text(first, payment_types).withColumn("trip_id", surrogate_key(TRIP_KEY))


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(F.col("locationid").alias("location_id"), "borough", "zone", "service_zone")


def fct_trips(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """Trips with zone and borough names on both ends; unknown zones keep the trip."""
    named = join_dimension_twice(trips, dim, "location_id", "pickup_location_id",
                                 "dropoff_location_id", {"borough": "borough", "zone": "zone"},
                                 ("pickup_", "dropoff_"), how="left")
    return named.select(
        "trip_id", "vendor_id", "service_type", "rate_code_id",
        "pickup_location_id", "pickup_borough", "pickup_zone",
        "dropoff_location_id", "dropoff_borough", "dropoff_zone",
        "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
        "passenger_count", "trip_distance", "trip_type",
        minutes_between("pickup_datetime", "dropoff_datetime").alias("trip_duration_minutes"),
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "congestion_surcharge", "improvement_surcharge", "total_amount",
        "payment_type", "payment_type_description")


def dim_vendors(fact: DataFrame) -> DataFrame:
    """Vendors that occur in the fact; distinct ids first, names after."""
    return fact.select("vendor_id").distinct().withColumn("vendor_name", vendor_name("vendor_id"))
