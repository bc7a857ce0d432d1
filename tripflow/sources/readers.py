"""Readers. Paths may be local, HDFS or any object store the cluster is configured for."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import project_with_default
from .json_arrays import json_array_records


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; all columns text. Needs only the header line, no inference pass."""
    return spark.read.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss", header: bool = True) -> DataFrame:
    """CSV (also gzipped) with a declared schema; trailing values beyond it are ignored.

    One gzip file is one task, however large: convert such inputs to Parquet once.
    """
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
            .option("timestampFormat", timestamp_format).csv(path))


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 recursive: bool = False) -> DataFrame:
    """Parquet file, directory or glob. `recursive` reads files at any depth, without partition
    columns from folder names. A declared schema saves the footer pass."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_days(spark: SparkSession, path: str, ts_column: str, start: date, end: date,
              day_column: str = "day", schema: T.StructType | None = None) -> DataFrame:
    """Rows with start <= ts < end from a table partitioned by the day of `ts_column`.

    The filter on the timestamp cannot prune the derived day folders, so the matching bound on the
    day is added; only those folders are listed into the scan.
    """
    rows = read_parquet(spark, path, schema)
    last_day = end - timedelta(days=1)
    return rows.where(F.col(day_column).between(F.lit(start), F.lit(last_day))
                      & (F.col(ts_column) >= F.lit(str(start)).cast("timestamp"))
                      & (F.col(ts_column) < F.lit(str(end)).cast("timestamp")))


def with_lineage(df: DataFrame, key: Column, key_name: str = "unique_row_id",
                 file_name: str = "filename") -> DataFrame:
    """Add the row key and the name of the file each row was read from."""
    return df.select(key.alias(key_name), F.col("_metadata.file_name").alias(file_name), "*")


def external_table(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None,
                   file_format: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """Schema over files, queried by name: a temporary view, so nothing is copied."""
    reader = spark.read.format(file_format).options(**(options or {}))
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def read_json_records(spark: SparkSession, path: str, keys: list[str], record_list: str | None = None,
                      default: str = "N/A") -> DataFrame:
    """Chosen keys of JSON objects as text, `default` where a key is missing.

    Input is one JSON object per line; or, with `record_list`, files of any size that hold the objects
    in a list under that key of their top level (see `json_arrays`).
    """
    if record_list is None:
        records = spark.read.text(path).select(F.col("value").alias("record"))
    else:
        records = json_array_records(spark, path, record_list)
    return records.select(*project_with_default("record", keys, default))


def read_pages(spark: SparkSession, path: str, record_schema: T.StructType,
               record_list: str = "docs", page_schema: T.StructType | None = None) -> DataFrame:
    """Landed pages of a paged API, one JSON object per line, to one row per record.

    `page_schema` declares page-level columns to keep on every record.
    """
    fields = page_schema.fields if page_schema is not None else []
    schema = T.StructType([*fields, T.StructField(record_list, T.ArrayType(record_schema))])
    return (spark.read.schema(schema).json(path)
            .select(*[f.name for f in fields], F.inline(F.col(record_list))))


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lookup table kept as CSV with a header, with typed columns and of any size. Spark sees the
    size of the file and broadcasts small ones."""
    return read_csv(spark, path, schema)


MAX_INLINE_SEED = 1000


def seed(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Small lookup table held in code or configuration.

    The rows become literals of the plan, so that Spark knows how small the table is and broadcasts
    it. Larger lookups belong in a file: see `read_seed`.
    """
    if not 0 < len(rows) <= MAX_INLINE_SEED:
        raise ValueError(f"a seed has 1 to {MAX_INLINE_SEED} rows, not {len(rows)}")
    literals = [F.struct(*[F.lit(value).cast(f.dataType).alias(f.name)
                           for value, f in zip(row, schema.fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))
