"""First results, corrections and late rows next to a simulation, batch by batch."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow.schemas import declared
from tripflow.streaming import lateness, sources

SCHEMA = declared("k string, ts timestamp, amount bigint, extra double")
START = datetime(2024, 5, 1)
DELAY, SIZE = timedelta(seconds=5), timedelta(minutes=1)


def run(spark, folder, batches, late_for, every_start=True):
    """Land one batch after another, each on a restart of the job; all that was published."""
    landing, out, checkpoint = (str(folder / n) for n in ("landing", "out", "checkpoint"))
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream = sources.with_event_time(sources.file_stream(spark, landing, SCHEMA), "ts", "5 seconds")
        found = lateness.windows_with_lateness(stream, "ts", SIZE, "k", "amount", late_for)
        lateness.side_output_sink(found, out, checkpoint).awaitTermination()
    return spark.read.schema(found.schema).parquet(out)


def simulate(batches, late_for):
    """What each batch publishes: the watermark is that of the batches before."""
    out, late, open_, mark, newest = [], [], {}, datetime.min, None
    for rows in batches:
        groups = {}
        for row in rows:
            if row[1] is not None:
                start = START + (row[1] - START) // SIZE * SIZE
                groups.setdefault((start, row[0]), []).append(row)
        for (start, key), own in groups.items():
            end = start + SIZE
            if end + late_for <= mark:
                late += own
                continue
            state = open_.setdefault((start, key), [0, 0, -1])
            state[0] += len(own)
            state[1] += sum(r[2] or 0 for r in own)
            if end <= mark:
                state[2] += 1
                out.append((start, key, "correction" if state[2] else "first", state[2], *state[:2]))
        times = [r[1] for r in rows if r[1] is not None]
        if times:
            newest = max([*times, *([newest] if newest else [])])
            mark = max(mark, newest - DELAY)
        for (start, key), state in list(open_.items()):
            if start + SIZE <= mark and state[2] < 0:
                state[2] = 0
                out.append((start, key, "first", 0, *state[:2]))
            if start + SIZE + late_for <= mark:
                del open_[start, key]
    return Counter(out), Counter(late)


def published(df):
    found = Counter((r.window_start, r.k, r.kind, r.revision, r.num_trips, r.total) for r in lateness.results(df).collect())
    return found, Counter(tuple(r) for r in lateness.late_rows(df, SCHEMA).collect())


def at(seconds, key="a", amount=1):
    return key, START + timedelta(seconds=seconds), amount, seconds / 3


def test_a_window_is_published_corrected_and_closed(spark, tmp_path):
    batches = [
        [at(10), at(20, "b"), at(50)],
        [at(70)],                      # closes the first minute of both keys
        [at(30, amount=5)],            # a correction
        [at(31), at(32, amount=None)],  # one more, both rows in it
        [at(40, "c")],                 # a key that was never there: its first result
        [at(300)],                     # the lateness of the first two minutes ends
        [at(45), at(55, "c", 7)],      # too late: as rows
    ]
    df = run(spark, tmp_path, batches, timedelta(minutes=2))
    assert published(df) == simulate(batches, timedelta(minutes=2))
    first = {(r.k, r.kind, r.revision): (r.num_trips, r.total) for r in lateness.results(df).where(
        F.col("window_start") == F.lit(START)).collect()}
    assert first == {("a", "first", 0): (2, 2), ("a", "correction", 1): (3, 7), ("a", "correction", 2): (5, 8),
                     ("b", "first", 0): (1, 1), ("c", "first", 0): (1, 1)}
    newest = {(r.window_start, r.k): r.num_trips for r in lateness.newest_results(df, "k").collect()}
    assert newest == {(START, "a"): 5, (START, "b"): 1, (START, "c"): 1, (START + SIZE, "a"): 1}
    assert {r.k for r in lateness.late_rows(df, SCHEMA).collect()} == {"a", "c"}


def test_rows_of_a_batch_may_close_their_own_window(spark, tmp_path):
    batches = [[at(10), at(400)], [at(11), at(900)], [at(12)]]
    df = run(spark, tmp_path, batches, timedelta(minutes=10))
    assert published(df) == simulate(batches, timedelta(minutes=10))


@pytest.mark.parametrize("late_for", [timedelta(0), timedelta(seconds=90)])
def test_odd_rows_and_no_lateness(spark, tmp_path, late_for):
    batches = [[], [(None, START, 1, None), ("a", None, 1, None), at(0, amount=None)], [at(65), at(3)], [], [at(1, None), at(200)],
               [at(59.999999), at(60)]]
    df = run(spark, tmp_path, batches, late_for)
    assert published(df) == simulate(batches, late_for)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_is_in_one_output(spark, tmp_path, seed):
    rnd = random.Random(seed)
    batches = [[at(max(0, 100 * n - rnd.choice([0, 5, 50, 200, 600]) + rnd.random() * 30), rnd.choice("ab"), rnd.randint(1, 9))
                for _ in range(40)] for n in range(6)]
    batches.append([at(10_000)])
    df = run(spark, tmp_path, batches, timedelta(minutes=3))
    assert published(df) == simulate(batches, timedelta(minutes=3))
    counted = lateness.newest_results(df, "k").agg(F.sum("num_trips")).head()[0]
    assert counted + lateness.late_rows(df, SCHEMA).count() == 6 * 40


def test_other_queries_keep_their_state_store(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run(spark, tmp_path, [[at(1)]], timedelta(0))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    for bad in (timedelta(microseconds=1), timedelta(seconds=-1)):
        with pytest.raises(ValueError):
            run(spark, tmp_path / "bad", [[at(1)]], bad)
