"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._cols import as_col


def keep_first(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """First row of each key in the given order.

    `row_number() = 1` lets Spark cut each key to one row per map task before the shuffle, so a
    hot key does not reach one task whole. Rows holding NULLs are kept like any others.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_position", F.row_number().over(window))
            .where("_position = 1").drop("_position"))


def keep_min_by(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """The row of each key that is smallest by one expression, NULL first. An aggregate over whole
    rows would sort them twice, so this is `keep_first` as well."""
    return keep_first(df, keys, [as_col(order).asc_nulls_first()])
