"""Trips of hired vehicles: the third feed has bases and zones, but no fares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encode_base_id


def hire_days(trips: DataFrame) -> DataFrame:
    """Dates, zones and the encoded dispatch base of each trip."""
    return trips.select("dispatching_base_num", encode_base_id("dispatching_base_num").alias("base_id"),
                        F.to_date("pickup_datetime").alias("pickup_date"),
                        F.to_date("dropoff_datetime").alias("dropoff_date"),
                        "PULocationID", "DOLocationID")
