"""Previous or next value over an ordering that no single task could hold.

A plain `lag` needs a whole window partition in one task: all rows when there is no group, a third
of them when one group is hot. Here equal rows are first counted together, the distinct rows are
range-partitioned by group and order (which cuts a hot group into many ranges), `lag` runs inside
each range, and a second, small window links the edge rows of neighbouring ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counted_neighbours(df: DataFrame, group: list[str], order: list[str], source: str,
                       following: bool, name: str,
                       wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Distinct (group, order) rows with `n_rows` copies and the neighbour's `source` value.

    `source` is one of the order columns; `following` picks the next row instead of the previous.
    `wanted` gets the neighbour column and may say which rows the caller can use; it keeps the
    second window small. Edge rows are returned in any case.
    """
    columns = [*group, *order]
    distinct = df.groupBy(*columns).agg(F.count("*").alias("n_rows"))
    ranged = (distinct.repartitionByRange(*columns)
              .withColumn("_range", F.spark_partition_id()))

    inside = Window.partitionBy("_range", *group).orderBy(*order)
    shift = F.lead if following else F.lag
    near = (ranged
            .withColumn("_at_start", F.lag(F.lit(1)).over(inside).isNull())
            .withColumn("_at_end", F.lead(F.lit(1)).over(inside).isNull())
            .withColumn(name, shift(source).over(inside)))
    open_edge = F.col("_at_end") if following else F.col("_at_start")
    is_edge = F.col("_at_start") | F.col("_at_end")
    if wanted is not None:
        near = near.where(is_edge | F.coalesce(wanted(F.col(name)), F.lit(False)))

    # all edge rows of a group meet in one partition (at most two per range); others stay apart
    across = (Window.partitionBy(*group, F.when(is_edge, F.lit(-1)).otherwise(F.col("_range")))
              .orderBy(*order))
    linked = (near.withColumn("_linked", shift(source).over(across))
              .withColumn(name, F.when(open_edge, F.col("_linked")).otherwise(F.col(name))))
    return linked.select(*columns, name, "n_rows")
