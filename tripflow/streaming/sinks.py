"""Stream sinks on plain folders."""

from __future__ import annotations

import time
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.dedup import keep_first
from ..sources.writers import child_names, delete_path, matching_paths

#: Run of batches that are written without a query.
DIRECT = "0" * 15 + "_direct"


def run_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run every interval, or once over what is there when `every` is None."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Finished rows to Parquet files, each exactly once; start position and progress live in the
    checkpoint, so a restart resumes."""
    writer = df.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint)
    return run_trigger(writer, every).start(path)


# --- keyed tables: path/changes/run=../batch_id=.. and path/base/v=../{folded,rows} ---

def run_of(batch: DataFrame, path: str) -> str:
    """The run a micro-batch belongs to: the time of its first batch and the query's id, which lives
    in the checkpoint. A restart on the same checkpoint goes on with the run, a new checkpoint
    begins a later one."""
    spark = batch.sparkSession
    query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    known = [name for name in child_names(spark, f"{path}/changes") if name.endswith(f"_{query_id}")]
    return known[0].removeprefix("run=") if known else f"{time.time_ns() // 1_000_000:015d}_{query_id}"


def write_batch(batch: DataFrame, batch_id: int, path: str, run: str = DIRECT) -> None:
    """One micro-batch of changed rows to its own folder. A repeated batch replaces its folder, so
    applying it twice changes nothing."""
    batch.write.mode("overwrite").parquet(f"{path}/changes/run={run}/batch_id={batch_id}")


def upsert_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = None,
                ) -> StreamingQuery:
    """Updating results to a keyed table: each micro-batch adds only the rows it changed, and
    `read_upserted` picks the newest row per key. Work per batch does not grow with the table.

    A replay from the start on a new checkpoint is a later run, whose rows replace those of earlier
    runs by key."""
    runs: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_of(batch, path))
        write_batch(batch, batch_id, path, runs[0])

    writer = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(write))
    return run_trigger(writer, every).start()


def _batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(run, batch) of all complete change folders, from one listing."""
    found = []
    for marker in matching_paths(spark, f"{path}/changes/run=*/batch_id=*/_SUCCESS"):
        run, batch = marker.split("/")[-3:-1]
        found.append((run.removeprefix("run="), int(batch.removeprefix("batch_id="))))
    return sorted(found)


def _newest_base(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """Number of the newest complete base (-1 without one), and the last batch it has of each run."""
    versions = [int(p.split("/")[-3].removeprefix("v="))
                for p in matching_paths(spark, f"{path}/base/v=*/rows/_SUCCESS")]
    if not versions:
        return -1, {}
    version = max(versions)
    return version, _folded(spark, path, version)


def _folded(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    return {r["run"]: r["batch"] for r in spark.read.parquet(f"{path}/base/v={version}/folded").collect()}


def _state(spark: SparkSession, path: str, keys: list[str]) -> tuple[DataFrame, int, dict[str, int]]:
    """Newest row per key with its run and batch; the base it stands on and all that it holds."""
    version, folded = _newest_base(spark, path)
    later = [(run, n) for run, n in _batches(spark, path) if n > folded.get(run, -1)]
    parts = [spark.read.parquet(f"{path}/base/v={version}/rows")] if version >= 0 else []
    if later:
        folder = f"{path}/changes"
        changes = spark.read.option("basePath", folder).parquet(
            *[f"{folder}/run={run}/batch_id={n}" for run, n in later])
        parts.append(changes.withColumns({"_run": F.col("run").cast("string"),
                                          "_batch": F.col("batch_id").cast("bigint")})
                     .drop("run", "batch_id"))
    if not parts:
        raise FileNotFoundError(f"no keyed table at {path}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    newest = keep_first(rows, keys, [F.desc("_run"), F.desc("_batch")])
    return newest, version, {**folded, **{run: n for run, n in later}}


def read_upserted(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state of a keyed table: last compaction plus later changes, the row of the newest run
    and batch per key."""
    return _state(spark, path, keys)[0].drop("_run", "_batch")


def compact(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Fold all complete changes into a new base. Readers switch when its marker is written.

    Folders that the base before had already folded are removed: nobody has begun to read them
    since. Those folded now stay until the next compaction, for readers that are under way.
    """
    state, version, folded = _state(spark, path, keys)
    before = _folded(spark, path, version) if version >= 0 else {}
    if folded == before:
        return
    base = f"{path}/base/v={version + 1}"
    (spark.createDataFrame(sorted(folded.items()), "run string, batch bigint").coalesce(1)
     .write.mode("overwrite").parquet(f"{base}/folded"))
    state.write.mode("overwrite").parquet(f"{base}/rows")
    for run, n in _batches(spark, path):
        if n <= before.get(run, -1):
            delete_path(spark, f"{path}/changes/run={run}/batch_id={n}")
    for name in child_names(spark, f"{path}/base"):
        if int(name.removeprefix("v=")) < version:
            delete_path(spark, f"{path}/base/{name}")


# --- late rows ---

class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, over all batches of all queries of a session.

    Add it with `spark.streams.addListener`; `dropped` is keyed by query id. Aggregations count
    late rows after the map-side step, so equal keys of one task count once.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(
            operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark dropped in the batches whose progress Spark still holds
    (`spark.sql.streaming.numRecentProgressUpdates`, 100 unless set). `LateRows` counts all."""
    return sum(operator.get("numRowsDroppedByWatermark", 0)
               for progress in query.recentProgress for operator in progress["stateOperators"])
