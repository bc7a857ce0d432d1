"""How evenly operators spread their work when one key holds a third of all rows.

Runs each operator over rows that Spark generates, with broadcasts off, and reads from Spark's event log the
largest share of a stage's shuffled records that went to a single task.

Usage: python tools/skew_shares.py [rows]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripflow.operators import dedup, incremental, quality, sets
from tripflow.plans import reports
from tripflow.session import configure
from tripflow.streaming import windows


def operators(df):
    ranges = df.select(F.col("v").alias("low"), (F.col("v") + 1).alias("high"))
    return {
        "keep_first": lambda: dedup.keep_first(df, ["k"], ["ts"]),
        "keep_min_by": lambda: dedup.keep_min_by(df, ["k"], "ts"),
        "sequential_values, grouped": lambda: quality.sequential_values(df, "v", group_by=["k"]),
        "sequential_values, whole table": lambda: quality.sequential_values(df, "v"),
        "mutually_exclusive_ranges, whole table":
            lambda: quality.mutually_exclusive_ranges(ranges, "low", "high"),
        "session on a table": lambda: windows.session(df, "ts", "2 seconds", ["k"], {"n": F.count("*")}),
        "hourly_revenue": lambda: reports.hourly_revenue(df, "ts", "k", "amount", "2020-01-01"),
        "insert_new": lambda: incremental.insert_new(df.where("v % 2 = 0").select("k", "v"),
                                                     df.select("k", "v"), "k"),
        "one_sided_rows": lambda: sets.one_sided_rows(df.select("k"), df.select("k").where("k <> 5")),
    }


def shares(log: str) -> dict[str, list[str]]:
    groups, tasks = {}, {}
    for path in glob.glob(f"{log}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerStageSubmitted":
                properties = event.get("Properties") or {}
                groups[event["Stage Info"]["Stage ID"]] = properties.get("spark.jobGroup.id")
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                tasks.setdefault(event["Stage ID"], []).append(read)
    found: dict[str, list[str]] = {}
    for stage, group in sorted(groups.items()):
        read = tasks.get(stage, [0])
        if sum(read):
            found.setdefault(group, []).append(
                f"{sum(read)} records, {len(read)} tasks, largest share {max(read) / sum(read):.2f}")
    return found


def main() -> None:
    n_rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    log = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    source = f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/rows"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log}")
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1m")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 9973)
    (spark.range(n_rows, numPartitions=16)
     .select(key.alias("k"), F.col("id").alias("v"),
             F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"),
             (F.col("id") % 100).cast("double").alias("amount"))
     .write.parquet(source))
    taken = {}
    for name, run in operators(spark.read.parquet(source)).items():
        spark.sparkContext.setJobGroup(name, name)
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        taken[name] = time.perf_counter() - start
    spark.stop()
    for name, stages in shares(log).items():
        if name in taken:
            print(f"{name}: {taken[name]:.1f} s")
            for stage in stages:
                print(f"    {stage}")


if __name__ == "__main__":
    main()
