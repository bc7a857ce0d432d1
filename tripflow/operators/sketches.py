"""Distinct counts that add up: one sketch per day, merged for any range of days.

An exact distinct count of a range reads all its rows again. A HyperLogLog sketch has a fixed size (about
2^lg bytes at most) whatever it has seen, and the sketch of a range is the union of those of its days, so a stored table
of daily sketches answers every range, and a new or reloaded day replaces its own row only.

The estimate of a union has a standard error of 1.04 / sqrt(2^lg): `error_bound` is three times that,
2.4 % at the default. Small sets are counted almost exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 14


def error_bound(lg: int = LG) -> float:
    """Relative error that estimates stay within, three standard errors."""
    return 3 * 1.04 / 2 ** (lg / 2)


def _number(column: str) -> Column:
    """Any value as a 64-bit number; NULL stays NULL and is not counted."""
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def day_sketches(df: DataFrame, ts: str, columns: list[str], keys: list[str] | None = None,
                 lg: int = LG, day: str = "day") -> DataFrame:
    """One row per day (and keys): the number of rows and a sketch of each column's values.

    Sketches are built before the shuffle, so a day's rows travel as one small row per map task.
    """
    made = [F.hll_sketch_agg(_number(c), lg).alias(c) for c in columns]
    return df.groupBy(F.to_date(ts).alias(day), *(keys or [])).agg(F.count("*").alias("n_rows"), *made)


def merged_counts(sketches: DataFrame, columns: list[str], by: list[Column | str] | None = None) -> DataFrame:
    """Rows and estimated distinct values per column, over all sketches or per group of them."""
    counts = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns]
    return sketches.groupBy(*(by or [])).agg(F.sum("n_rows").alias("n_rows"), *counts)


def distinct_between(sketches: DataFrame, columns: list[str], start: str, end: str, day: str = "day") -> DataFrame:
    """Estimates over start <= day <= end."""
    return merged_counts(sketches.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))), columns)
