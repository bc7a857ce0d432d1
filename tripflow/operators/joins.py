"""Joins against dimensions and between reports.

No broadcast hints: Spark broadcasts a side whose size it has checked against
`spark.sql.autoBroadcastJoinThreshold` (also at run time, under adaptive execution), and otherwise
shuffles and splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension_twice(facts: DataFrame, dim: DataFrame, dim_key: str, first_key: str,
                         second_key: str, attributes: dict[str, str], prefixes: tuple[str, str],
                         how: str = "left") -> DataFrame:
    """Join one dimension under two roles, e.g. pickup and dropoff zone.

    `attributes` maps dimension columns to suffixes; `{"zone": "zone"}` with prefixes
    `("pickup_", "dropoff_")` adds pickup_zone and dropoff_zone.
    """
    def role(prefix: str) -> DataFrame:
        return dim.select(F.col(dim_key).alias(f"_{prefix}key"),
                          *[F.col(c).alias(f"{prefix}{suffix}") for c, suffix in attributes.items()])

    joined = facts
    for prefix, key in zip(prefixes, (first_key, second_key), strict=True):
        joined = (joined.join(role(prefix), F.col(key) == F.col(f"_{prefix}key"), how)
                  .drop(f"_{prefix}key"))
    return joined


def lookup_with_default(facts: DataFrame, lookup: DataFrame, key: str, key_default, value: str,
                        value_default, output: str) -> DataFrame:
    """Replace a NULL key by its default, then add the looked-up text or the default text."""
    keyed = facts.withColumn(key, F.coalesce(F.col(key), F.lit(key_default)))
    small = lookup.select(F.col(key).alias("_lookup_key"), F.col(value).alias("_lookup_value"))
    return (keyed.join(small, F.col(key) == F.col("_lookup_key"), "left")
            .withColumn(output, F.coalesce(F.col("_lookup_value"), F.lit(value_default)))
            .drop("_lookup_key", "_lookup_value"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            child_where: str | Column | None = None,
            parent_where: str | Column | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    child = child.where(F.col(child_key).isNotNull())
    parent = parent.where(F.col(parent_key).isNotNull())
    child = child.where(child_where) if child_where is not None else child
    parent = parent.where(parent_where) if parent_where is not None else parent
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, F.col(child_key) == F.col("_parent_key"), "left_anti")
