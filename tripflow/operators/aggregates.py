"""Aggregations that are reused across reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import slugify_text
from .columns import quoted

_COMPARE = {
    "=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    "like": lambda a, b: a.like(b), "ilike": lambda a, b: a.ilike(b),
}


def group_by_first(df: DataFrame, n: int):
    """Group by the first n columns."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}")
    return df.groupBy(*[quoted(name) for name in df.columns[:n]])


def pivot(column: str | Column, values: list, agg: str = "sum", cmp: str = "=", prefix: str = "",
          suffix: str = "", then_value=1, else_value=0, quote_identifiers: bool = True,
          distinct: bool = False, alias: bool = True) -> list[Column]:
    """One aggregate per value: agg(CASE WHEN column cmp value THEN then ELSE else END).

    Use inside `df.groupBy(..).agg(*pivot(..))`. Unlike `groupBy().pivot()` a value without rows
    gives the aggregate of `else_value`, not NULL, and the comparison is free.
    """
    column = F.col(column) if isinstance(column, str) else column
    compare = _COMPARE[cmp.lower()]

    def constant(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    def measure(value) -> Column:
        case = F.when(compare(column, F.lit(value)), constant(then_value)).otherwise(
            constant(else_value))
        return F.call_function(agg, case) if not distinct else _distinct(agg, case)

    def name(value) -> str:
        plain = f"{prefix}{value}{suffix}"
        return plain if quote_identifiers else slugify_text(plain)

    return [measure(v).alias(name(v)) if alias else measure(v) for v in values]


def _distinct(agg: str, case: Column) -> Column:
    if agg == "count":
        return F.count_distinct(case)
    if agg == "sum":
        return F.sum_distinct(case)
    if agg in ("min", "max"):
        return F.call_function(agg, case)
    raise ValueError(f"distinct is not supported with {agg!r}")


def column_values(df: DataFrame, column: str, order_by: list[Column] | None = None,
                  max_records: int | None = None, where: str | Column | None = None) -> DataFrame:
    """Distinct values of a column as `value` with their row counts, most frequent first; ties in
    value order."""
    rows = df.where(where) if where is not None else df
    counted = rows.groupBy(quoted(column).alias("value")).agg(F.count("*").alias("n_rows"))
    ordered = counted.orderBy(*(order_by or [F.desc("n_rows"), F.asc("value")]))
    return ordered.limit(max_records) if max_records is not None else ordered


def column_value_list(df: DataFrame, column: str, max_records: int, default: list | None = None,
                      **options) -> list:
    """The values as a Python list, for `pivot`. The caller says how many distinct values are still
    no mistake; more are an error, not a shorter list."""
    rows = column_values(df, column, max_records=max_records + 1, **options).head(max_records + 1)
    if len(rows) > max_records:
        raise ValueError(f"{column} has more than {max_records} distinct values")
    return [row["value"] for row in rows] or (default or [])


def single_value(df: DataFrame, default=None):
    """First column of a one-row result; `default` when there is no row or the value is NULL."""
    row = df.head(1)
    return default if not row or row[0][0] is None else row[0][0]


def results_as_dict(df: DataFrame, max_rows: int) -> dict[str, list]:
    """Columns of a configuration table as lists. The caller says how many rows the driver may take;
    more are an error."""
    rows = df.head(max_rows + 1)
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; this helper is for configuration tables")
    return {name: [row[i] for row in rows] for i, name in enumerate(df.columns)}


def top_groups(df: DataFrame, keys: list[str], k: int, ascending: bool = False,
               count_name: str = "n_rows") -> DataFrame:
    """The k most (or least) frequent groups; ties in key order."""
    direction = F.asc if ascending else F.desc
    return (df.groupBy(*keys).agg(F.count("*").alias(count_name))
            .orderBy(direction(count_name), *[F.asc(key) for key in keys]).limit(k))


def explode_top_values(df: DataFrame, array: str | Column, k: int, value_name: str = "value",
                       count_name: str = "n_rows", where: str | Column | None = None) -> DataFrame:
    """Most frequent elements of an array column; `where` filters the elements."""
    array = F.col(array) if isinstance(array, str) else array
    elements = df.select(F.explode(array).alias(value_name))
    elements = elements.where(where) if where is not None else elements
    return top_groups(elements, [value_name], k, count_name=count_name)


def skew_check(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Heaviest group keys, to be looked at before a join."""
    return top_groups(df, keys, k)


def column_profile(df: DataFrame, bucket: Column, measure: Column) -> DataFrame:
    """Rows, share of all rows and mean measure per value bucket."""
    buckets = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_rows"),
                                                     F.avg(measure).alias("avg_measure"))
    # the total comes from the buckets; both read the same grouped rows
    total = buckets.agg(F.sum("n_rows").alias("n")).scalar()
    return buckets.withColumn("share", F.col("n_rows") / total)
