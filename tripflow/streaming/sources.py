"""Stream sources."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(servers: str, topic: str, start: str | datetime = "earliest",
                  max_offsets: int | None = None) -> dict[str, str]:
    """Options of a topic source. `start` is earliest, latest or a moment; it only counts while the
    query has no checkpoint."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if isinstance(start, datetime):
        moment = start if start.tzinfo else start.replace(tzinfo=timezone.utc)
        options["startingTimestamp"] = str(int(moment.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    elif start in ("earliest", "latest"):
        options["startingOffsets"] = start
    else:
        raise ValueError("start must be earliest, latest or a datetime")
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def topic_stream(spark: SparkSession, options: dict[str, str], schema: T.StructType) -> DataFrame:
    """JSON records of a topic as declared columns."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """New files below a folder or glob."""
    reader = spark.readStream.format(file_format).schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def with_event_time(df: DataFrame, ts_column: str, delay: str = "5 seconds") -> DataFrame:
    """Event time with a bounded delay: later rows no longer change finished windows."""
    return df.withColumn(ts_column, F.col(ts_column).cast("timestamp")).withWatermark(ts_column, delay)


def peek(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First n records of a bounded read."""
    return df.orderBy(*order_by).limit(n)
