"""Raw feed to cleaned, common trip rows."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_text, safe_cast
from ..schemas import GREEN_FEED, NUMERIC, YELLOW_FEED

# --- fixed values: accepted ranges and codes of a staged trip ---
MAX_PASSENGERS = 6
LOCATION_IDS = (1, 265)
TOTAL_AMOUNT = ("2.50", "500")
PAYMENT_CODES = [1, 2, 3, 4, 6]
MAX_RATE_CODE = 6
MTA_TAXES = ["0", "0.5"]
EXTRAS = ["0", "0.5", "1.0", "2.5", "3.0", "3.5"]
FILE_MONTH = r"\d{4}-\d{2}"


@dataclass(frozen=True)
class Feed:
    """What differs between the feeds."""

    service: str
    pickup: str
    dropoff: str
    max_distance: int
    has_trip_type: bool
    schema: T.StructType

    @property
    def natural_key(self) -> list[str]:
        """Fields that identify a trip; amounts may differ between loads of the same trip."""
        return ["VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID"]


GREEN = Feed("Green", "lpep_pickup_datetime", "lpep_dropoff_datetime", 50, True, GREEN_FEED)
YELLOW = Feed("Yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", 100, False, YELLOW_FEED)


#: Digits after the point that staged numbers are rounded to, as the source model's numeric type does.
DIGITS = 9


def rounded_number(name: str, data_type: str = NUMERIC, strict: bool = False) -> Column:
    """A number as a decimal, rounded half up to its digits, so that the noise of a double goes.

    With `strict` a double that the decimal does not hold exactly is an error. A number beyond the
    type's range always is.
    """
    value = F.col(name)
    number = value.cast(data_type)
    if not strict:
        return number
    same = number.cast("double") == value.cast("double")
    problem = F.concat(F.lit(f"{name} does not fit {data_type}: "), value.cast("string"))
    return F.when(value.isNull() | same, number).otherwise(F.raise_error(problem).cast(data_type))


def stage_trips(raw: DataFrame, feed: Feed, numeric: str = NUMERIC, strict: bool = False) -> DataFrame:
    """Common names and exact types; rows without a vendor go. Identifiers that are not numbers
    become NULL. Amounts are rounded to the digits of `numeric`, or must fit them if `strict`; a wider type takes
    amounts beyond its range, which are errors. All other bad values are errors."""
    def to(name: str, data_type: str, alias: str) -> Column:
        return F.col(name).cast(data_type).alias(alias)

    def number_or_null(name: str, alias: str) -> Column:
        return safe_cast(name, "bigint").alias(alias)

    amounts = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
               "improvement_surcharge", "total_amount"]
    def amount(name: str) -> Column:
        return rounded_number(name, numeric, strict).alias(name)

    return raw.where(F.col("VendorID").isNotNull()).select(
        to("unique_row_id", "string", "unique_row_id"),
        to("filename", "string", "file_name"),
        to("VendorID", "int", "vendor_id"),
        number_or_null("RatecodeID", "rate_code_id"),
        number_or_null("PULocationID", "pickup_location_id"),
        number_or_null("DOLocationID", "dropoff_location_id"),
        to(feed.pickup, "timestamp", "pickup_datetime"),
        to(feed.dropoff, "timestamp", "dropoff_datetime"),
        to("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        to("passenger_count", "int", "passenger_count"),
        amount("trip_distance"),
        *([number_or_null("trip_type", "trip_type")] if feed.has_trip_type else []),
        *[amount(name) for name in amounts],
        number_or_null("payment_type", "payment_type"),
        amount("congestion_surcharge"))


def file_month_matches(ts: str = "pickup_datetime", file_name: str = "file_name") -> Column:
    """Month of the trip = month in the name of the file it came from."""
    return month_text(ts) == F.regexp_extract(file_name, FILE_MONTH, 0)


def _bound(value: str, half_units: int) -> Column:
    """A number moved by halves of the last digit, as the double nearest to it."""
    return F.lit(float(Decimal(value) + half_units * Decimal(5).scaleb(-DIGITS - 1)))


def _rounds_between(name: str, low: str, high: str) -> Column:
    """low <= the number rounded half up <= high, tested on the number as it is, so that the bounds
    reach the scan. Halves round away from zero."""
    at_least = F.col(name) >= _bound(low, -1) if Decimal(low) > 0 else F.col(name) > _bound(low, -1)
    return at_least & (F.col(name) < _bound(high, 1))


def _rounds_to_one_of(name: str, values: list[str]) -> Column:
    found = [_rounds_between(name, v, v) for v in values]
    return reduce(lambda one, other: one | other, found)


def accepted_trip(feed: Feed) -> Column:
    """The staging filter, on raw rows. A NULL in any tested column drops the row.

    Amounts count as they are staged, rounded to nine digits, but are tested as plain doubles: only
    rows that stay are converted, and the bounds can skip parts of the files.
    """
    rules = [
        F.col("passenger_count").cast("int").between(0, MAX_PASSENGERS),
        _rounds_between("trip_distance", "0", str(feed.max_distance)),
        F.col(feed.dropoff).cast("timestamp") > F.col(feed.pickup).cast("timestamp"),
        safe_cast("PULocationID", "bigint").between(*LOCATION_IDS),
        safe_cast("DOLocationID", "bigint").between(*LOCATION_IDS),
        _rounds_between("total_amount", *TOTAL_AMOUNT),
        F.col("fare_amount") >= _bound("0", 1),
        safe_cast("payment_type", "bigint").isin(PAYMENT_CODES),
        safe_cast("RatecodeID", "bigint") <= MAX_RATE_CODE,
        _rounds_to_one_of("mta_tax", MTA_TAXES),
        _rounds_to_one_of("extra", EXTRAS),
        file_month_matches(feed.pickup, "filename"),
    ]
    return reduce(lambda one, other: one & other, rules)


def date_window(df: DataFrame, ts: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Optional development window, start <= ts < end."""
    if start:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end:
        df = df.where(F.col(ts) < F.lit(end).cast("timestamp"))
    return df


def stage_feed(raw: DataFrame, feed: Feed, start: str | None = None, end: str | None = None) -> DataFrame:
    """Staged and filtered rows of one feed."""
    return stage_trips(date_window(raw.where(accepted_trip(feed)), feed.pickup, start, end), feed)


def union_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both feeds under one schema, tagged with the service. Yellow cabs only take street hails,
    so their trip type is 1. Load columns stay behind."""
    load_columns = ["unique_row_id", "file_name"]
    tagged_green = green.drop(*load_columns).withColumn("service_type", F.lit(GREEN.service))
    tagged_yellow = (yellow.drop(*load_columns)
                     .withColumns({"trip_type": F.lit(1).cast("bigint"),
                                   "service_type": F.lit(YELLOW.service)}))
    return tagged_green.unionByName(tagged_yellow)


def clean_trips(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips with a distance, passengers and a fare; and the row counts before and after, from one
    scan."""
    good = (F.col("trip_distance") > 0) & (F.col("passenger_count") > 0) & (F.col("fare_amount") > 0)
    audit = df.agg(F.count("*").alias("rows_before"), F.count_if(good).alias("rows_after"))
    return df.where(good), audit
