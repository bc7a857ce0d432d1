"""Windowed aggregation, the same for batch and stream."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _windowed(df: DataFrame, window: Column, keys: list[str],
              measures: dict[str, Column]) -> DataFrame:
    grouped = df.groupBy(window.alias("_window"), *keys)
    return (grouped.agg(*[measure.alias(name) for name, measure in measures.items()])
            .select(F.col("_window.start").alias("window_start"),
                    F.col("_window.end").alias("window_end"), *keys, *measures))


def tumble(df: DataFrame, ts: str, size: str, keys: list[str],
           measures: dict[str, Column]) -> DataFrame:
    """Fixed windows that do not overlap."""
    return _windowed(df, F.window(ts, size), keys, measures)


def hop(df: DataFrame, ts: str, size: str, slide: str, keys: list[str],
        measures: dict[str, Column]) -> DataFrame:
    """Fixed windows that start every `slide`; a row falls into size / slide of them."""
    return _windowed(df, F.window(ts, size, slide), keys, measures)


# how the results of two parts of a session make the result of the whole
_JOINED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _joins(name: str, measure: Column) -> Callable[[str], Column]:
    """The way to combine a plain sum, count, min or max; any other measure has to say its own."""
    call = re.match(r"Column<'(sum|count|min|max)\(", str(measure))
    # a column's text does not tell whether it is distinct
    if not call or measure._jc.node().isDistinct():
        raise ValueError(f"`merge` must say how {name} of two parts of a session combines")
    return _JOINED[call[1]]


def session(df: DataFrame, ts: str, gap: str, keys: list[str], measures: dict[str, Column],
            merge: dict[str, Callable[[str], Column]] | None = None,
            chunk: str = "1 hour") -> DataFrame:
    """Windows that grow while rows come at most `gap` apart.

    On a stream this is Spark's session window. On a table that window would bring all rows of a
    key to one task, so sessions are first built per key and time chunk. Only the sessions that
    come within a gap of a chunk's edge, at most two per key and chunk, can go on in another chunk;
    those are linked in a second step. `merge` says how a measure of two parts combines; plain
    sums, counts, minima and maxima need none, and any other measure without one is an error, on
    streams as well.
    """
    combine = {name: (merge or {}).get(name) or _joins(name, measure) for name, measure in measures.items()}
    if df.isStreaming:
        return _windowed(df, F.session_window(ts, gap), keys, measures)

    chunked = df.withColumn("_chunk", F.window(ts, chunk))
    parts = _windowed(chunked, F.session_window(ts, gap), [*keys, "_chunk"], measures)
    reach = F.expr(f"INTERVAL {gap}")
    at_edge = ((F.col("window_start") <= F.col("_chunk.start") + reach)
               | (F.col("window_end") >= F.col("_chunk.end")))
    # sessions inside a chunk are complete and stay apart from the linking
    place = F.when(at_edge, F.lit(None)).otherwise(F.col("_chunk.start"))
    parts = parts.withColumn("_inside", place).drop("_chunk")

    by_start = Window.partitionBy(*keys, "_inside").orderBy("window_start")
    opens = F.col("window_start") > F.lag("window_end").over(by_start)
    numbered = (parts.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int"))
                .withColumn("_session", F.sum("_opens").over(by_start)))
    return (numbered.groupBy(*keys, "_inside", "_session")
            .agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"),
                 *[combine[name](name).alias(name) for name in measures])
            .select("window_start", "window_end", *keys, *measures))


def window_rollup(windows: DataFrame, count: str, amount: str) -> DataFrame:
    """Window results per window start: number of keys, total count, total amount in cents."""
    return windows.groupBy("window_start").agg(
        F.count("*").alias("locations"), F.sum(count).alias("total_trips"),
        F.round(F.sum(amount), 2).alias("revenue"))


def best_window(windows: DataFrame, measure: str, tie_break: list[str]) -> DataFrame:
    """The window with the highest measure."""
    return windows.orderBy(F.desc(measure), *tie_break).limit(1)
