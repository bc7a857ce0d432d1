"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def boundary_diff(part: str, start: Column | str, end: Column | str) -> Column:
    """Number of `part` boundaries crossed from `start` to `end`.

    This is the warehouse meaning of datediff: 00:00:59 to 00:01:01 is one minute. Spark's
    `timestampdiff` truncates the elapsed time instead and gives zero. Weeks start on Monday.
    """
    part, start, end = part.lower(), as_col(start), as_col(end)
    if part in _SECONDS:
        seconds = (F.unix_seconds(F.date_trunc(part, end).cast("timestamp"))
                   - F.unix_seconds(F.date_trunc(part, start).cast("timestamp")))
        return (seconds / F.lit(_SECONDS[part])).cast("bigint")
    if part == "day":
        return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    if part == "week":
        days = F.datediff(F.to_date(F.date_trunc("week", end)), F.to_date(F.date_trunc("week", start)))
        return (days / 7).cast("bigint")
    per_year = {"month": (12, F.month), "quarter": (4, F.quarter), "year": (1, lambda c: F.lit(0))}
    if part not in per_year:
        raise ValueError(f"unknown date part {part!r}")
    factor, position = per_year[part]
    return ((F.year(end) - F.year(start)) * factor + position(end) - position(start)).cast("bigint")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return boundary_diff("minute", start, end)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed whole seconds as fractional hours."""
    return F.timestamp_diff("SECOND", as_col(start), as_col(end)) / F.lit(3600.0)


def add_interval(part: str, amount: int | Column, ts: Column | str) -> Column:
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(part.upper(), amount, as_col(ts))


def epoch_ms_to_ts(ms: Column | str) -> Column:
    return F.timestamp_millis(as_col(ms))


def ts_to_epoch_ms(ts: Column | str) -> Column:
    return F.unix_millis(as_col(ts))


def parse_ts(text: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; text that does not match gives NULL."""
    return F.try_to_timestamp(as_col(text), F.lit(fmt))


def month_text(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")
