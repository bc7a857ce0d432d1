"""Generated tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boundary_diff


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..n as `generated_number`."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def _moment(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (date, datetime, str)):
        return F.lit(str(value)).cast("timestamp")
    raise TypeError("start and end must be dates, timestamps, text or columns")


def intervals_between(spark: SparkSession, start, end, datepart: str) -> int:
    """Number of `datepart` boundaries from start to end."""
    row = spark.range(1).select(boundary_diff(datepart, _moment(start), _moment(end))).head()
    return row[0]


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """One row per period from start; the end is not included. Column `date_<datepart>`."""
    periods = intervals_between(spark, start, end, datepart)
    if periods <= 0:
        raise ValueError("end must be after start")
    step = F.col("id").cast("int")
    return spark.range(periods).select(
        F.timestamp_add(datepart.upper(), step, _moment(start)).alias(f"date_{datepart}"))


def date_spine_over(bounds: DataFrame, datepart: str, start: str = "start", end: str = "end",
                    ) -> DataFrame:
    """Spine whose bounds come from a one-row-per-group table: other columns repeat per period."""
    kept = [c for c in bounds.columns if c not in (start, end)]
    periods = boundary_diff(datepart, F.col(start), F.col(end)).cast("int")
    return (bounds.select(*kept, F.col(start).alias("_start"), periods.alias("_periods"))
            .where("_periods > 0")
            .select(*kept, "_start", F.explode(F.sequence(F.lit(0), F.col("_periods") - 1)).alias("_step"))
            .select(*kept, F.timestamp_add(datepart.upper(), F.col("_step"), F.col("_start"))
                    .alias(f"date_{datepart}")))
