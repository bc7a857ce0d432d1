"""Incremental loads without a table format: anti-join merges, committed partitions and published versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources import committed
from ..sources.writers import child_names, is_complete


def insert_new(target: DataFrame, batch: DataFrame, key: str, dedup_batch: bool = False,
               within: str | None = None) -> DataFrame:
    """Rows of the batch whose key the target lacks; append them to the target.

    Equal new rows inside one batch are all inserted, unless `dedup_batch`. `within` names a column
    that the key is made from (such as the pickup time): the target is then read only between the
    batch's smallest and largest value or where it is NULL, which skips its older files and changes no
    result. The batch is read for its bounds too, so pass a stored one.
    """
    if within:
        low, high = F.min(within).alias("low"), F.max(within).alias("high")
        inside = F.col(within).between(batch.agg(low).scalar(), batch.agg(high).scalar())
        target = target.where(inside | F.col(within).isNull())
    known = target.select(F.col(key).alias("_known"))
    fresh = batch.join(known, F.col(key) == F.col("_known"), "left_anti")
    return fresh.dropDuplicates([key]) if dedup_batch else fresh


def rows_above_high_water(source: DataFrame, target: DataFrame, ts_column: str,
                          look_back: str | None = None) -> DataFrame:
    """Source rows newer than the newest target row; all rows when the target is empty.

    `look_back` (e.g. "3 days") moves the mark back, so that late rows are picked up again.
    """
    newest = F.max(ts_column)
    if look_back:
        newest = newest - F.expr(f"INTERVAL {look_back}")
    # the default is part of the subquery, so that the filter stays `column > value` and reaches the scan
    mark = target.agg(F.coalesce(newest, F.lit("0001-01-01").cast("timestamp")).alias("mark")).scalar()
    return source.where(F.col(ts_column) > mark)


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target with the batch's rows replacing or joining it by key; new columns are added, and are
    NULL on rows the batch does not touch. Keys must be unique in the batch."""
    incoming = batch.select(F.col(key).alias("_incoming"))
    untouched = target.join(incoming, F.col(key) == F.col("_incoming"), "left_anti")
    return untouched.unionByName(batch, allowMissingColumns=True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    numbers = [int(name[2:]) for name in child_names(spark, root)
               if name.startswith("v=") and name[2:].isdigit()]
    return sorted(n for n in numbers if is_complete(spark, f"{root}/v={n}"))


def publish(df: DataFrame, root: str) -> str:
    """Write the next version of a table. Readers see it once its `_SUCCESS` marker exists, so the
    version being read is never overwritten."""
    versions = _versions(df.sparkSession, root)
    path = f"{root}/v={versions[-1] + 1 if versions else 0}"
    df.write.mode("overwrite").parquet(path)
    return path


def published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The latest, or a given, complete version."""
    versions = _versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no complete version below {root}")
    return spark.read.parquet(f"{root}/v={versions[-1] if version is None else version}")


def _staged(batch: DataFrame, partition: str, label: str) -> tuple[DataFrame, list[str]]:
    """A batch at rest, read once more than once, and the partition folders it touches."""
    spark, path = batch.sparkSession, work_dir(batch.sparkSession, label)
    batch.write.partitionBy(partition).parquet(path)
    touched = sorted(n for n in child_names(spark, path) if n.startswith(f"{partition}="))
    return spark.read.schema(batch.schema).parquet(path), touched


def merge_partitions(spark: SparkSession, batch: DataFrame, root: str, key: str, partition: str,
                     ) -> list[str]:
    """Upsert into a committed table partitioned by a column that the key determines, rewriting only
    the partitions the batch touches. Returns their values.

    All touched partitions change with one commit (see `sources.committed`): a run that breaks off
    anywhere leaves the table as it was and can be repeated.
    """
    incoming, touched = _staged(batch, partition, "merge-batch")
    if not touched:
        return []
    base, columns, result = committed.snapshot(spark, root), batch.schema, incoming
    if any(p in base.loads for p in touched):
        result = upsert(committed.read_snapshot(spark, root, base, touched), incoming, key)
        columns = result.schema
    load, written = committed.write_load(result.hint("rebalance", F.col(partition)), root, partition)
    committed.commit(spark, root, base, load, written, partition, columns, replace=True)
    return [committed.partition_value(name) for name in touched]


def insert_new_partitions(spark: SparkSession, batch: DataFrame, root: str, key: str, partition: str,
                          dedup_batch: bool = False) -> list[str]:
    """Insert-only merge into a committed table partitioned by a column that the key determines: rows
    whose key the table lacks are added, with one commit. Returns the partitions that got rows.

    Only partitions that the batch holds can hold its keys, and only those are listed and read, so the
    work of a load follows the batch and not the table. Equal new rows inside one batch are all
    inserted, unless `dedup_batch`.
    """
    incoming, touched = _staged(batch, partition, "insert-batch")
    base = committed.snapshot(spark, root)
    fresh = incoming.dropDuplicates([key]) if dedup_batch else incoming
    if any(p in base.loads for p in touched):
        known = committed.read_snapshot(spark, root, base, touched).select(
            F.col(partition).alias("_partition"), F.col(key).alias("_known"))
        same = (F.col(partition) == F.col("_partition")) & (F.col(key) == F.col("_known"))
        fresh = fresh.join(known, same, "left_anti")
    load, written = committed.write_load(fresh.hint("rebalance", F.col(partition)), root, partition)
    if written:
        committed.commit(spark, root, base, load, written, partition, batch.schema, replace=False)
    return [committed.partition_value(name) for name in written]


def compact_partitions(spark: SparkSession, root: str, most_loads: int = 8) -> list[str]:
    """Rewrite the partitions that more than `most_loads` loads make up as one load. Returns them."""
    base = committed.snapshot(spark, root)
    many = sorted(p for p, loads in base.loads.items() if len(loads) > most_loads)
    if many:
        rows = committed.read_snapshot(spark, root, base, many).hint("rebalance", F.col(base.partition))
        load, written = committed.write_load(rows, root, base.partition)
        committed.commit(spark, root, base, load, written, base.partition, base.columns, replace=True)
    return [committed.partition_value(name) for name in many]
