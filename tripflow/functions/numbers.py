"""NULL-tolerant arithmetic and bucketing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def _zero_if_null(fields) -> list[Column]:
    if isinstance(fields, (str, Column)):
        raise TypeError("pass a list of columns")
    if not fields:
        raise ValueError("at least one column is needed")
    return [F.coalesce(as_col(f), F.lit(0)) for f in fields]


def safe_add(fields: list[Column | str]) -> Column:
    """Sum of the fields, NULL counted as zero."""
    return reduce(lambda a, b: a + b, _zero_if_null(fields))


def safe_subtract(fields: list[Column | str]) -> Column:
    """First field minus all others, NULL counted as zero."""
    return reduce(lambda a, b: a - b, _zero_if_null(fields))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, or NULL where either side is NULL or the denominator is zero."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def width_bucket(value: Column | str, low, high, buckets: int) -> Column:
    """Bucket 1..n of equal width; 0 below `low`, n + 1 from `high` on."""
    return F.width_bucket(as_col(value).cast("double"), F.lit(float(low)), F.lit(float(high)),
                          F.lit(int(buckets)).cast("bigint"))
