"""Writers. Every write is repeatable: overwrite replaces half-written output, `_SUCCESS` marks a
complete one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system, so that object stores work too."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, from one listing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return [status.getPath().toString() for status in found or []]


def mount(spark: SparkSession, store: str, folder: str) -> str:
    """A folder under a store's name, so that jobs need not know where it lies: `viewfs://store/data`. Paths
    below it go through Hadoop's file systems only, as those of an object store do. The folder has no spaces."""
    conf = spark._jsc.hadoopConfiguration()
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop_path.getFileSystem(conf)
    files.mkdirs(hadoop_path)
    conf.set(f"fs.viewfs.mounttable.{store}.link./data", files.makeQualified(hadoop_path).toUri().toString())
    return f"viewfs://{store}/data"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def convert_to_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite as Parquet, round-robin into a chosen number of files, or as partitioned now."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)


def create_table_if_absent(df: DataFrame, name: str, file_format: str = "parquet") -> bool:
    """Write a catalog table unless there is one of that name. Returns whether it wrote."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.format(file_format).saveAsTable(name)
    return True


def write_if_absent(df: DataFrame, path: str, files: int | None = None) -> bool:
    """Write once: skip when the target is complete. Returns whether it wrote."""
    if is_complete(df.sparkSession, path):
        return False
    convert_to_parquet(df, path, files)
    return True


def write_single_file(df: DataFrame, path: str) -> None:
    """One output file. Only for aggregated reports: the last stage runs in one task."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str | None = None, file_format: str = "parquet",
                options: dict[str, str] | None = None) -> None:
    """Append to a table. Pass `file_format="jdbc"` with url and dbtable options for a database;
    Spark then writes one connection per partition."""
    writer = df.write.format(file_format).mode("append").options(**(options or {}))
    writer.save(path) if path else writer.save()


def create_empty(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """An empty table with the columns of `df`, replacing what is there."""
    df.limit(0).write.format(file_format).mode("overwrite").save(path)


def write_table(df: DataFrame, target: str, file_format: str = "parquet", mode: str = "overwrite",
                options: dict[str, str] | None = None) -> None:
    """Write to a warehouse table or path; connector and staging folder come as options."""
    df.write.format(file_format).mode(mode).options(**(options or {})).save(target)


def create_table_as(df: DataFrame, name: str, file_format: str = "parquet",
                    path: str | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE .. AS SELECT in the session catalog."""
    writer = df.write.format(file_format).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_by_day(df: DataFrame, path: str, ts_column: str, cluster_by: list[str] | None = None,
                 day_column: str = "day", mode: str = "overwrite") -> None:
    """Table partitioned by the day of a timestamp and sorted by the cluster columns in each file.

    The rebalance hint brings a day's rows together, but lets adaptive execution split a day that
    is too large for one task and merge days that are tiny.
    """
    rows = df.withColumn(day_column, F.to_date(ts_column))
    (rows.hint("rebalance", F.col(day_column)).sortWithinPartitions(day_column, *(cluster_by or []))
     .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(day_column)
     .parquet(path))


def write_by_month(df: DataFrame, path: str, ts_column: str, service: str | Column) -> None:
    """Backfill of all months in one job, into service=/year=/month= folders.

    With dynamic partition overwrite only the months present in `df` are replaced.
    """
    keys = ["service", "year", "month"]
    rows = df.withColumns({"service": F.lower(service), "year": F.year(ts_column),
                           "month": F.month(ts_column)})
    (rows.hint("rebalance", *[F.col(k) for k in keys])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
