"""Revenue reports. All are one partial and one final hash aggregate; a hot zone is combined
map-side before the shuffle."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hours_between
from ..schemas import MONEY_COLUMNS

MONEY = "decimal(18,2)"
#: Digits after the point that doubles are rounded to before they are added up.
SCALE = 9


def exact_sum(df: DataFrame, column: str, strict: bool = False) -> Column:
    """Sum as a decimal that does not depend on the order of the rows, unlike a sum of doubles.

    Each double is rounded to nine digits: its nearest whole number, and the units of the ninth digit
    that it is off, are two sums of longs, fast and exact. With `strict` a value with more digits is an
    error. One that is no number or reaches 2^63, and an overflow of a sum (at eighteen thousand
    million rows of one group at the earliest), always is. Decimals are added up as they are.
    """
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.FloatType):  # by its shortest decimal, not by the nearest double
        value = value.cast("string").cast("double")
    elif not isinstance(kind, T.DoubleType):
        return F.sum(value)
    unit = float(10 ** SCALE)
    whole = F.rint(value)
    units = F.rint((value - whole) * unit)
    if strict:
        problem = F.concat(F.lit(f"{column} is no number of at most {SCALE} decimals: "), value.cast("string"))
        units = F.when(value.isNull() | (whole + units / unit == value), units).otherwise(
            F.raise_error(problem).cast("double"))
    return (F.sum(whole.cast("bigint")).cast("decimal(19,0)")
            + F.sum(units.cast("bigint")).cast("decimal(19,0)") * Decimal(1).scaleb(-SCALE))


def money_sum(df: DataFrame, column: str, result_type: str = MONEY, strict: bool = False) -> Column:
    """Exact total of a money column. A total beyond the result type is an error."""
    return exact_sum(df, column, strict).cast(result_type)


def exact_mean(df: DataFrame, column: str, digits: int) -> Column:
    """Mean of the non-NULL values, rounded half up, independent of row order."""
    return F.round(exact_sum(df, column) / F.count(column), digits)


def hourly_revenue(df: DataFrame, ts: str, zone: str, amount: str, start: str) -> DataFrame:
    """Revenue and records per hour and zone from a start date."""
    return (df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
            .groupBy(F.date_trunc("hour", ts).alias("hour"), F.col(zone).alias("zone"))
            .agg(money_sum(df, amount).alias("amount"), F.count("*").alias("number_records")))


def hourly_revenue_both(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Hourly reports of both services side by side; an hour and zone in only one of them stays.

    Both inputs are already hash-partitioned by the join key through their aggregation.
    """
    def renamed(report: DataFrame, service: str) -> DataFrame:
        return report.withColumnsRenamed({"amount": f"{service}_amount",
                                          "number_records": f"{service}_number_records"})

    return renamed(green, "green").join(renamed(yellow, "yellow"), on=["hour", "zone"], how="outer")


def with_zone_names(report: DataFrame, zones: DataFrame, zone_key: str = "location_id") -> DataFrame:
    """Replace the zone id by the zone's columns; ids without a zone go."""
    named = zones.withColumnRenamed("zone", "zone_name")
    return report.join(named, report["zone"] == named[zone_key]).drop("zone", zone_key)


def monthly_revenue_decimal(trips: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    """Revenue per zone, month and service in exact money, with average passengers and distance."""
    return (trips.groupBy(F.col(zone).alias("revenue_zone"),
                          F.date_trunc("month", "pickup_datetime").alias("revenue_month"),
                          "service_type")
            .agg(*[money_sum(trips, c).alias(_monthly_name(c)) for c in MONEY_COLUMNS],
                 F.avg("passenger_count").alias("avg_monthly_passenger_count"),
                 F.avg(F.col("trip_distance").cast("double")).alias("avg_monthly_trip_distance")))


def _monthly_name(column: str) -> str:
    return "revenue_monthly_fare" if column == "fare_amount" else f"revenue_monthly_{column}"


def monthly_report(trips: DataFrame) -> DataFrame:
    """Rounded monthly figures in zone order, newest month first."""
    return (trips.groupBy(F.col("pickup_location_id").alias("zone"),
                          F.date_format(F.date_trunc("month", "pickup_datetime"), "yyyy-MM").alias("month"),
                          F.col("service_type").alias("type"))
            .agg(money_sum(trips, "fare_amount").alias("fare"), money_sum(trips, "tip_amount").alias("tips"),
                 money_sum(trips, "total_amount").alias("total"),
                 F.round(F.avg("passenger_count"), 1).alias("avg_passengers"),
                 exact_mean(trips, "trip_distance", 2).cast("double").alias("avg_distance"))
            .orderBy("zone", F.desc("month"), "type"))


def daily_stats(trips: DataFrame) -> DataFrame:
    """Trips, revenue and mean distance per zone, day and service."""
    return (trips.groupBy(F.col("pickup_location_id").alias("pickup_zone_id"),
                          F.date_trunc("day", "pickup_datetime").alias("pickup_day"), "service_type")
            .agg(F.count("*").alias("total_trips"), money_sum(trips, "total_amount").alias("daily_revenue"),
                 exact_mean(trips, "trip_distance", 2).cast("decimal(10,2)").alias("avg_distance")))


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Monthly mart over the fact; trips of unknown zones count as one zone."""
    return (fact.groupBy(F.coalesce("pickup_zone", F.lit("Unknown Zone")).alias("pickup_zone"),
                         F.to_date(F.date_trunc("month", "pickup_datetime")).alias("revenue_month"),
                         "service_type")
            .agg(*[F.sum(c).alias(f"revenue_monthly_{c}") for c in MONEY_COLUMNS],
                 F.count("trip_id").alias("total_monthly_trips"),
                 F.avg("passenger_count").alias("avg_monthly_passenger_count"),
                 F.avg("trip_distance").alias("avg_monthly_trip_distance")))


def monthly_zone_revenue_of_trips(trips: DataFrame, dim: DataFrame) -> DataFrame:
    """The monthly mart straight from unique trips: sums per zone id first, names after, so that
    only the pickup zone is looked up, and for groups rather than trips."""
    month = F.to_date(F.date_trunc("month", "pickup_datetime")).alias("revenue_month")
    means = {"passenger_count": "avg_monthly_passenger_count", "trip_distance": "avg_monthly_trip_distance"}
    per_id = trips.groupBy("pickup_location_id", month, "service_type").agg(
        *[F.sum(c).alias(f"revenue_monthly_{c}") for c in MONEY_COLUMNS],
        F.count("*").alias("total_monthly_trips"),
        *[F.sum(c).alias(f"_sum_{c}") for c in means], *[F.count(c).alias(f"_n_{c}") for c in means])
    zones = dim.select(F.col("location_id").alias("pickup_location_id"), F.col("zone").alias("_zone"))
    return (per_id.join(zones, "pickup_location_id", "left")
            .groupBy(F.coalesce("_zone", F.lit("Unknown Zone")).alias("pickup_zone"), "revenue_month",
                     "service_type")
            .agg(*[F.sum(f"revenue_monthly_{c}").cast("decimal(28,9)").alias(f"revenue_monthly_{c}")
                   for c in MONEY_COLUMNS],
                 F.sum("total_monthly_trips").alias("total_monthly_trips"),
                 *[(F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).cast("double").alias(name)
                   for c, name in means.items()]))


def rarest_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The zone with the fewest pickups. Trips are counted per id before the join."""
    per_id = trips.groupBy("pickup_location_id").agg(F.count("*").alias("n"))
    return (per_id.join(zones, per_id.pickup_location_id == zones.location_id)
            .groupBy("zone").agg(F.sum("n").alias("pickup_count"))
            .orderBy("pickup_count", "zone").limit(1))


def longest_trip(trips: DataFrame) -> DataFrame:
    return trips.agg(F.max(hours_between("pickup_datetime", "dropoff_datetime"))
                     .alias("longest_trip_hours"))


def revenue_pairs(df: DataFrame, ts: str, zone: str, amount: str) -> DataFrame:
    """(hour, zone) to revenue in cents and count, in the types of the keyed-reduce report."""
    return (df.groupBy(F.date_trunc("hour", ts).alias("hour"), F.col(zone).alias("zone"))
            .agg(money_sum(df, amount, "decimal(10,2)").alias("revenue"),
                 F.count("*").cast("int").alias("count")))
