"""Windows that publish when they close, are corrected while late rows are allowed, and set aside the
rows that come later still.

A stream's own windows either wait for late rows (append, a longer delay) or show every state on the
way (update). Here each window has its own state with timers: when the watermark reaches its end its
first result is published and the state stays; a row that comes within the allowed lateness publishes a correction;
when the watermark reaches end plus lateness the state goes. Rows that come after that, or find no window
left to change, come out as rows of kind `late`. Every row with a time is in exactly one of the three: in a
first result, in a correction, or late.

Spark drops rows behind the watermark before they reach a stateful operator, where it can tell their
time. Here the time enters the operator as a plain number, so that all rows reach it and it decides by
the watermark itself.

State is one small record per open window and key, kept by the cluster's state store (RocksDB, on
each executor's disk and in the checkpoint). A hot key's rows of one micro-batch pass through one
task one by one; bound them by the source's rows per trigger.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import ROCKSDB_STATE
from .sinks import run_trigger

FIRST, CORRECTION, LATE = "first", "correction", "late"
_Out = Row("start_us", "window_key", "kind", "revision", "num_trips", "total", "late_row")
_STATE = "n long, amount long, published boolean, revision int"
# microseconds, so that rows set aside come back as they were
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class _Window(StatefulProcessor):
    """One window of one key."""

    def __init__(self, size_ms: int, lateness_ms: int):
        self.size_ms, self.lateness_ms = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", _STATE)

    def _result(self, key: tuple, kind: str, n: int, amount: int, revision: int) -> Row:
        return _Out(key[0], key[1], kind, revision, n, amount, None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark, end = timerValues.getCurrentWatermarkInMs(), key[0] // 1000 + self.size_ms
        if end + self.lateness_ms <= watermark:
            for row in rows:
                yield _Out(key[0], key[1], LATE, 0, 1, row["amount"], row["late_row"])
            return
        known = self.state.exists()
        n, amount, published, revision = self.state.get() if known else (0, 0, False, 0)
        closed = end <= watermark
        if closed and known and not published:  # its timer fires in this batch: the rows come after it
            yield self._result(key, FIRST, n, amount, 0)
            self.handle.deleteTimer(end)
            self.handle.registerTimer(end + self.lateness_ms)
            published = True
        for row in rows:
            n, amount = n + 1, amount + (row["amount"] or 0)
        if closed:
            revision += published
            yield self._result(key, CORRECTION if published else FIRST, n, amount, revision)
        if not known:
            self.handle.registerTimer(end + self.lateness_ms if closed else end)
        self.state.update((n, amount, published or closed, revision))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end, expiry = key[0] // 1000 + self.size_ms, expiredTimerInfo.getExpiryTimeInMs()
        if expiry < end + self.lateness_ms or not self.lateness_ms:
            n, amount, published, revision = self.state.get()
            if not published:
                yield self._result(key, FIRST, n, amount, 0)
            self.state.update((n, amount, True, revision))
        if expiry >= end + self.lateness_ms:
            self.state.clear()
        else:
            self.handle.registerTimer(end + self.lateness_ms)

    def close(self) -> None:
        pass


def _ms(length: timedelta) -> int:
    whole, rest = divmod(length, timedelta(milliseconds=1))
    if rest or whole < 0:
        raise ValueError(f"a length of whole milliseconds is wanted, not {length}")
    return whole


def windows_with_lateness(rows: DataFrame, ts: str, size: timedelta, key: str, amount: str,
                          lateness: timedelta) -> DataFrame:
    """A stream with a watermark on `ts` to (window_start, window_end, key, kind, revision, num_trips,
    total, late_row).

    Fixed windows of `size`, aligned to the epoch. `amount` is a column of whole units (such as cents); NULLs
    add nothing. kind `first` is the result of a window when it closes, `correction` the whole
    result again after rows that came at most `lateness` behind it, once per micro-batch, `revision` counting up;
    a window that gets its first row after closing publishes at once. kind `late` is a row that came
    later, as JSON in `late_row`: see `late_rows`. Rows without a time are in no window and left out.
    """
    size_ms, lateness_ms = _ms(size), _ms(lateness)
    if not size_ms:
        raise ValueError("a window has a length")
    micros = F.unix_micros(F.col(ts))
    keyed = rows.where(F.col(ts).isNotNull()).select(
        (micros - F.pmod(micros, F.lit(size_ms * 1000))).alias("start_us"), F.col(key).alias("window_key"),
        F.col(amount).cast("bigint").alias("amount"), F.to_json(F.struct("*"), _TIMES).alias("late_row"))
    schema = T.StructType([
        T.StructField("start_us", T.LongType()), keyed.schema["window_key"], T.StructField("kind", T.StringType()),
        T.StructField("revision", T.IntegerType()), T.StructField("num_trips", T.LongType()),
        T.StructField("total", T.LongType()), T.StructField("late_row", T.StringType())])
    found = keyed.groupBy("start_us", "window_key").transformWithState(
        _Window(size_ms, lateness_ms), schema, "Append", "EventTime")
    return found.select(
        F.timestamp_micros("start_us").alias("window_start"),
        F.timestamp_micros(F.col("start_us") + size_ms * 1000).alias("window_end"),
        F.col("window_key").alias(key), "kind", "revision", "num_trips", "total", "late_row")


def side_output_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Results, corrections and late rows to a folder each, every row exactly once. The query, and no
    other of the session, runs on the state store that has timers."""
    conf = df.sparkSession.conf
    before = {name: conf.get(name, None) for name in ROCKSDB_STATE}
    writer = (df.writeStream.format("parquet").outputMode("append").partitionBy("kind")
              .option("checkpointLocation", checkpoint))
    try:
        for name, value in ROCKSDB_STATE.items():
            conf.set(name, value)
        return run_trigger(writer, every).start(path)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def results(published: DataFrame) -> DataFrame:
    """First results and corrections, as rows of their own."""
    return published.where(F.col("kind").isin(FIRST, CORRECTION)).drop("late_row")


def newest_results(published: DataFrame, key: str) -> DataFrame:
    """The last result of each window."""
    newest = F.max_by(F.struct("window_end", "revision", "num_trips", "total"), "revision").alias("r")
    return results(published).groupBy("window_start", key).agg(newest).select("window_start", key, "r.*")


def late_rows(published: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that came too late, as they were."""
    rows = published.where(F.col("kind") == LATE)
    return rows.select(F.from_json("late_row", schema, _TIMES).alias("r")).select("r.*")
