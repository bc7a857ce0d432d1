"""File-level audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def storage_audit(spark: SparkSession, trees: dict[str, str], pattern: str = "*") -> DataFrame:
    """Total bytes, file count and mean file size per named tree, with its size relative to the
    first tree. Only file listings are read: the content column is pruned."""
    def sizes(name: str, path: str) -> DataFrame:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", pattern).load(path))
        return files.select(F.lit(name).alias("tree"), "length")

    listed = reduce(DataFrame.union, [sizes(n, p) for n, p in trees.items()])
    totals = listed.groupBy("tree").agg(F.sum("length").alias("total_bytes"),
                                        F.count("*").alias("n_files"),
                                        F.avg("length").alias("mean_bytes"))
    base = totals.where(F.col("tree") == next(iter(trees))).select("total_bytes").scalar()
    return totals.withColumn("ratio_to_first", F.col("total_bytes") / base)


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines of text files, gzipped or not."""
    return spark.read.text(path).agg(F.count("*").alias("n_lines"))
