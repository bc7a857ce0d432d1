"""Streaming jobs over the event table, run to the end of what is there.

Finished windows of append jobs are compared up to the last watermark; jobs with updating results
are compared whole.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from ..functions import encode_json
from ..schemas import declared
from ..session import work_dir
from ..sources import readers
from ..streaming import jobs, lateness, sinks, sources, windows
from . import _tables as t
from ._registry import query

_DELAY = "5 seconds"
_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"
_EVENTS = t.SCHEMAS["events"]


def _stream(spark, sf_dir, delay=_DELAY):
    """The event table as a stream; the glob also matches a folder of files."""
    rows = sources.file_stream(spark, f"{sf_dir}/event[s].parquet", _EVENTS)
    return sources.with_event_time(rows, "ts", delay)


def _run_append(spark, df, label, schema=None):
    """Run an append job over all present input and read its finished rows back."""
    path, checkpoint = work_dir(spark, label), work_dir(spark, f"{label}-checkpoint")
    sinks.append_sink(df, path, checkpoint).awaitTermination()
    return readers.read_parquet(spark, path, schema or df.schema)


def _run_upsert(spark, df, label, keys):
    path, checkpoint = work_dir(spark, label), work_dir(spark, f"{label}-checkpoint")
    sinks.upsert_sink(df, path, checkpoint).awaitTermination()
    return sinks.read_upserted(spark, path, keys)


def _cents(df):
    """Exact amounts, so that totals do not depend on row order."""
    return df.withColumn("value", t.to_cents("value"))


def _bucket_sql(size: str, columns: str, keys: str = "", origin: str = "TIMESTAMP '1970-01-01'") -> str:
    select, group = (f", {keys}", f", {keys}") if keys else ("", "")
    return f"""SELECT window_start, window_start + INTERVAL {size} AS window_end{select}, {columns}
FROM (SELECT *, time_bucket(INTERVAL {size}, ts, {origin}) AS window_start FROM events)
GROUP BY window_start{group}"""


@query("stream_passthrough", """SELECT user_id AS "PULocationID", event_id AS "DOLocationID", value AS trip_distance,
    value * 2 AS total_amount, epoch_ms(epoch_us(ts) // 1000) AS pickup_datetime FROM events""")
def stream_passthrough(spark, sf_dir):
    rides = _stream(spark, sf_dir).select(
        F.col("user_id").alias("PULocationID"), F.col("event_id").alias("DOLocationID"),
        F.col("value").alias("trip_distance"), (F.col("value") * 2).alias("total_amount"),
        F.unix_millis("ts").alias("tpep_pickup_datetime"))
    return _run_append(spark, jobs.ride_events(rides), "passthrough")


@query("stream_json_topic", """SELECT user_id AS "PULocationID", CAST(value AS DOUBLE) AS trip_distance,
    date_trunc('second', ts)::TIMESTAMP AS event_timestamp FROM events""")
def stream_json_topic(spark, sf_dir):
    """Records travel as JSON text, as on a topic, and are decoded with a declared schema."""
    schema = declared("PULocationID bigint, trip_distance double, lpep_pickup_datetime string")
    texts = _stream(spark, sf_dir).select(encode_json(
        F.col("user_id").alias("PULocationID"), F.col("value").alias("trip_distance"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("lpep_pickup_datetime")).alias("value"))
    decoded = texts.select(F.from_json("value", schema).alias("r")).select("r.*")
    return _run_append(spark, jobs.green_events(decoded).drop("lpep_pickup_datetime"), "topic")


@query("stream_tumble_hour", """SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, user_id,
    count(*) AS num_trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_revenue
FROM events GROUP BY ALL""")
def stream_tumble_hour(spark, sf_dir):
    result = jobs.trips_and_revenue(_cents(_stream(spark, sf_dir)), "ts", "1 hour", "user_id", "value")
    return _run_upsert(spark, result, "tumble-hour", ["window_start", "user_id"])


@query("stream_tumble_10s", """SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start,
    user_id, count(*) AS num_trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2))
    AS total_revenue FROM events GROUP BY ALL""")
def stream_tumble_10s(spark, sf_dir):
    result = jobs.trips_and_revenue(_cents(_stream(spark, sf_dir)), "ts", "10 seconds", "user_id", "value")
    return _run_upsert(spark, result, "tumble-10s", ["window_start", "user_id"])


@query("stream_tumble_5min", f"""SELECT * FROM ({_bucket_sql('5 MINUTE', 'count(*) AS num_trips',
                                                               'event_type')}) WHERE {_CLOSED}""")
def stream_tumble_5min(spark, sf_dir):
    result = jobs.trips_per_window(_stream(spark, sf_dir), "ts", "5 minutes", "event_type")
    return _run_append(spark, result, "tumble-5min")


def _session_sql(gap: str) -> str:
    return f"""SELECT min(ts) AS window_start, max(ts) + INTERVAL {gap} AS window_end, user_id,
    count(*) AS num_trips
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session_id FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL {gap}
                   THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY user_id, session_id"""


@query("stream_session", f"SELECT * FROM ({_session_sql('5 MINUTE')}) WHERE {_CLOSED}")
def stream_session(spark, sf_dir):
    result = jobs.trips_per_session(_stream(spark, sf_dir), "ts", "5 minutes", "user_id")
    return _run_append(spark, result, "session")


_TOTAL = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_tip_amount"


@query("stream_tumble_total", f"SELECT * FROM ({_bucket_sql('1 HOUR', _TOTAL)}) WHERE {_CLOSED}")
def stream_tumble_total(spark, sf_dir):
    result = jobs.total_per_window(_cents(_stream(spark, sf_dir)), "ts", "1 hour", "value",
                                   "total_tip_amount")
    return _run_append(spark, result, "tumble-total")


_HOP_SQL = """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type,
    count(*) AS num_trips
FROM (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01')
             - to_minutes(15 * unnest(range(4))) AS window_start FROM events)
GROUP BY ALL"""


@query("stream_hop", f"SELECT * FROM ({_HOP_SQL}) WHERE {_CLOSED}")
def stream_hop(spark, sf_dir):
    result = jobs.trips_per_sliding_window(_stream(spark, sf_dir), "ts", "1 hour", "15 minutes",
                                           "event_type")
    return _run_append(spark, result, "hop")


@query("stream_upsert", """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type,
    count(*) AS num_trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_revenue
FROM events GROUP BY ALL""")
def stream_upsert(spark, sf_dir):
    """Three landings of the table, the last one older than the others: corrections replace rows,
    also across a compaction."""
    keys = ["window_start", "event_type"]
    path, landing, checkpoint = (work_dir(spark, p) for p in ("keyed", "landing", "checkpoint"))
    for wave in range(3):
        _land(spark, sf_dir, landing, wave)
        rows = sources.file_stream(spark, landing, _EVENTS)
        rows = sources.with_event_time(_cents(rows), "ts", "60 days")
        result = jobs.trips_and_revenue(rows, "ts", "1 day", "event_type", "value")
        sinks.upsert_sink(result, path, checkpoint).awaitTermination()
        if wave == 1:
            sinks.compact(spark, path, keys)
    return sinks.read_upserted(spark, path, keys)


def _land(spark, sf_dir, landing: str, wave: int) -> None:
    """Append one of three parts that make up the whole event table: most of the first half, most
    of the second half, and then the fifth of all rows that arrives late."""
    ts, late = F.col("ts"), F.col("event_id") % 5 == 0
    middle = F.lit("2024-01-16").cast("timestamp")
    part = [~late & (ts < middle), ~late & (ts >= middle), late][wave]
    t.event_rows(spark, sf_dir).where(part).write.mode("append").parquet(landing)


@query("stream_late_rows", """
WITH rows AS (SELECT *, event_id % 5 = 0 AS late,
                     date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end FROM events),
marks AS (SELECT max(ts) FILTER (NOT late) - INTERVAL 5 SECOND AS before_late,
                 max(ts) - INTERVAL 5 SECOND AS final FROM rows)
SELECT window_end - INTERVAL 1 HOUR AS window_start, window_end, event_type, count(*) AS num_trips
FROM rows, marks
WHERE (NOT late OR window_end > before_late) AND window_end <= final GROUP BY ALL""")
def stream_late_rows(spark, sf_dir):
    """Hourly counts when a fifth of the rows lands after the watermark has closed their windows:
    those rows are dropped. `sinks.rows_dropped_late` tells how many."""
    landing, path, checkpoint = (work_dir(spark, p) for p in ("landing", "late", "checkpoint"))
    for wave in range(3):
        _land(spark, sf_dir, landing, wave)
        rows = sources.with_event_time(sources.file_stream(spark, landing, _EVENTS), "ts", _DELAY)
        counted = jobs.trips_per_window(rows, "ts", "1 hour", "event_type")
        sinks.append_sink(counted, path, checkpoint).awaitTermination()
    return readers.read_parquet(spark, path, counted.schema)


@query("stream_late_correct", """SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, event_type,
    count(*) AS num_trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_revenue
FROM events GROUP BY ALL""")
def stream_late_correct(spark, sf_dir):
    """The same late rows under a delay that covers them: published windows are corrected."""
    path, landing, checkpoint = (work_dir(spark, p) for p in ("corrected", "landing", "checkpoint"))
    for wave in range(3):
        _land(spark, sf_dir, landing, wave)
        rows = sources.file_stream(spark, landing, _EVENTS)
        rows = sources.with_event_time(_cents(rows), "ts", "60 days")
        result = jobs.trips_and_revenue(rows, "ts", "1 hour", "event_type", "value")
        sinks.upsert_sink(result, path, checkpoint).awaitTermination()
    return sinks.read_upserted(spark, path, ["window_start", "event_type"])


_LATENESS = timedelta(days=10)
_FATES = """
rows AS (SELECT *, event_id % 5 = 0 AS late, date_trunc('hour', ts)::TIMESTAMP AS window_start,
                CAST(round(value * 100) AS BIGINT) AS cents FROM events),
marks AS (SELECT max(ts) FILTER (NOT late) - INTERVAL 5 SECOND AS before_late, max(ts) - INTERVAL 5 SECOND AS final
          FROM rows),
fates AS (SELECT *, window_start + INTERVAL 1 HOUR AS window_end,
                 CASE WHEN NOT late OR window_start + INTERVAL 1 HOUR > before_late THEN 'first'
                      WHEN window_start + INTERVAL 1 HOUR + INTERVAL 10 DAY > before_late THEN 'correction'
                      ELSE 'late' END AS fate FROM rows, marks)"""


def _lateness_run(spark, sf_dir):
    """Hourly windows over three landings, the last a fifth of all rows that comes late: closed windows
    take them for ten days more."""
    landing, path, checkpoint = (work_dir(spark, p) for p in ("landing", "lateness", "checkpoint"))
    for wave in range(3):
        _land(spark, sf_dir, landing, wave)
        rows = sources.with_event_time(sources.file_stream(spark, landing, _EVENTS), "ts", _DELAY)
        found = lateness.windows_with_lateness(
            rows.withColumn("cents", F.round(F.col("value") * 100).cast("bigint")), "ts", timedelta(hours=1),
            "event_type", "cents", _LATENESS)
        lateness.side_output_sink(found, path, checkpoint).awaitTermination()
    return readers.read_parquet(spark, path, found.schema)


@query("stream_lateness", f"""WITH {_FATES},
firsts AS (SELECT window_start, window_end, event_type, count(*) AS num_trips, CAST(sum(cents) AS BIGINT) AS total,
                  any_value(final) AS final FROM fates WHERE fate = 'first' GROUP BY 1, 2, 3),
more AS (SELECT window_start, window_end, event_type, count(*) AS num_trips, CAST(sum(cents) AS BIGINT) AS total
         FROM fates WHERE fate = 'correction' GROUP BY ALL)
SELECT * EXCLUDE (final), 'first' AS kind, CAST(0 AS INTEGER) AS revision FROM firsts WHERE window_end <= final
UNION ALL
SELECT m.window_start, m.window_end, m.event_type, m.num_trips + coalesce(f.num_trips, 0),
       m.total + coalesce(f.total, 0), CASE WHEN f.num_trips IS NULL THEN 'first' ELSE 'correction' END,
       CAST(CASE WHEN f.num_trips IS NULL THEN 0 ELSE 1 END AS INTEGER)
FROM more m LEFT JOIN firsts f USING (window_start, event_type)""")
def stream_lateness(spark, sf_dir):
    """A first result for each window when it closes, and a correction of its own row afterwards."""
    return lateness.results(_lateness_run(spark, sf_dir))


@query("stream_late_side", f"""WITH {_FATES}
SELECT event_id, ts, user_id, event_type, value, props FROM fates WHERE fate = 'late'""")
def stream_late_side(spark, sf_dir):
    """The rows that came after their window's lateness, whole."""
    return lateness.late_rows(_lateness_run(spark, sf_dir), _EVENTS)


@query("stream_lateness_balance", f"""WITH {_FATES},
seen AS (SELECT DISTINCT window_start, event_type, true AS seen FROM fates WHERE fate = 'first')
SELECT CASE WHEN fate = 'correction' AND seen IS NULL THEN 'first' ELSE fate END AS fate,
       CAST(count(*) AS BIGINT) AS n_rows
FROM fates LEFT JOIN seen USING (window_start, event_type), (SELECT any_value(final) AS last FROM fates)
WHERE fate = 'late' OR window_end <= last GROUP BY 1""")
def stream_lateness_balance(spark, sf_dir):
    """Rows in first results, rows that corrections added, late rows: each row is in one of them."""
    published = _lateness_run(spark, sf_dir)
    firsts = lateness.results(published).where("kind = 'first'")
    newest = lateness.newest_results(published, "event_type")
    counted = [(firsts, "first", F.col("num_trips")), (firsts, "correction", -F.col("num_trips")),
               (newest, "correction", F.col("num_trips")), (published.where("kind = 'late'"), "late", F.lit(1))]
    rows = [df.select(F.lit(fate).alias("fate"), n.cast("bigint").alias("n")) for df, fate, n in counted]
    return (reduce(lambda one, other: one.unionByName(other), rows)
            .groupBy("fate").agg(F.sum("n").alias("n_rows")).where("n_rows > 0"))


@query("stream_resume", "SELECT event_id, event_type, value FROM events")
def stream_resume(spark, sf_dir):
    """Stopped and restarted twice on one checkpoint: every row arrives once."""
    landing, path, checkpoint = (work_dir(spark, p) for p in ("landing", "resumed", "checkpoint"))
    for wave in range(3):
        _land(spark, sf_dir, landing, wave)
        rows = sources.file_stream(spark, landing, _EVENTS).select("event_id", "event_type", "value")
        sinks.append_sink(rows, path, checkpoint).awaitTermination()
    return readers.read_parquet(spark, path, rows.schema)


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """All records, and all of them again in a later batch; the copies are dropped by id."""
    landing, path, checkpoint = (work_dir(spark, p) for p in ("landing", "dedup", "checkpoint"))
    for _ in range(2):
        t.event_rows(spark, sf_dir).write.mode("append").parquet(landing)
        rows = sources.with_event_time(sources.file_stream(spark, landing, _EVENTS), "ts", "60 days")
        unique = jobs.without_replays(rows, "event_id").select("event_id", "user_id", "event_type")
        sinks.append_sink(unique, path, checkpoint).awaitTermination()
    return readers.read_parquet(spark, path, unique.schema)


@query("stream_replay", """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type,
    count(*) AS num_trips, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_revenue
FROM events GROUP BY ALL""")
def stream_replay(spark, sf_dir):
    """The whole topic three times, each on a new checkpoint and with a compaction after the second:
    the first two runs have wrong amounts, which the last one replaces by key."""
    keys, path = ["window_start", "event_type"], work_dir(spark, "replayed")
    for run in range(3):
        rows = _cents(_stream(spark, sf_dir))
        rows = rows.withColumn("value", F.col("value") if run == 2 else F.lit(run).cast("decimal(18,2)"))
        result = jobs.trips_and_revenue(rows, "ts", "1 day", "event_type", "value")
        sinks.upsert_sink(result, path, work_dir(spark, "checkpoint")).awaitTermination()
        if run == 1:
            sinks.compact(spark, path, keys)
    return sinks.read_upserted(spark, path, keys)


_PARITY_SQL = _bucket_sql("1 HOUR", "count(*) AS batch_trips, count(*) AS stream_trips", "event_type")


@query("batch_stream_parity", f"SELECT * FROM ({_PARITY_SQL}) WHERE {_CLOSED}")
def batch_stream_parity(spark, sf_dir):
    """The same function over the table and over the stream, side by side."""
    def hourly(df):
        return jobs.trips_per_window(df, "ts", "1 hour", "event_type")

    streamed = _run_append(spark, hourly(_stream(spark, sf_dir)), "parity")
    batch = hourly(t.event_rows(spark, sf_dir)).withColumnRenamed("num_trips", "batch_trips")
    keys = ["window_start", "window_end", "event_type"]
    return streamed.withColumnRenamed("num_trips", "stream_trips").join(batch, keys, "left")


@query("peek_events", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 10")
def peek_events(spark, sf_dir):
    return sources.peek(t.event_rows(spark, sf_dir).select("event_id", "ts", "event_type"), 10,
                        ["ts", "event_id"])


# --- the window functions on the whole table ---

@query("batch_session", _session_sql("5 MINUTE"))
def batch_session(spark, sf_dir):
    return jobs.trips_per_session(t.event_rows(spark, sf_dir), "ts", "5 minutes", "user_id")


@query("batch_hop", _HOP_SQL)
def batch_hop(spark, sf_dir):
    return jobs.trips_per_sliding_window(t.event_rows(spark, sf_dir), "ts", "1 hour", "15 minutes",
                                         "event_type")


@query("window_rollup", """SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start,
    count(DISTINCT user_id) AS locations, count(*) AS total_trips,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue FROM events GROUP BY 1""")
def window_rollup(spark, sf_dir):
    hourly = jobs.trips_and_revenue(_cents(t.event_rows(spark, sf_dir)), "ts", "1 hour", "user_id", "value")
    return windows.window_rollup(hourly, "num_trips", "total_revenue")


_BUSIEST_SQL = _bucket_sql("5 MINUTE", "count(*) AS num_trips", "user_id")


@query("busiest_window", f"{_BUSIEST_SQL} ORDER BY num_trips DESC, window_start, user_id LIMIT 1")
def busiest_window(spark, sf_dir):
    counted = jobs.trips_per_window(t.event_rows(spark, sf_dir), "ts", "5 minutes", "user_id")
    return windows.best_window(counted, "num_trips", ["window_start", "user_id"])


@query("longest_session", f"{_session_sql('5 MINUTE')} ORDER BY num_trips DESC, window_start, user_id LIMIT 1")
def longest_session(spark, sf_dir):
    sessions = jobs.trips_per_session(t.event_rows(spark, sf_dir), "ts", "5 minutes", "user_id")
    return windows.best_window(sessions, "num_trips", ["window_start", "user_id"])


@query("best_hour", f"{_bucket_sql('1 HOUR', _TOTAL)} ORDER BY total_tip_amount DESC, window_start LIMIT 1")
def best_hour(spark, sf_dir):
    totals = jobs.total_per_window(_cents(t.event_rows(spark, sf_dir)), "ts", "1 hour", "value",
                                   "total_tip_amount")
    return windows.best_window(totals, "total_tip_amount", ["window_start"])
