"""Catalog tables clustered by key: hashed into a fixed number of buckets and sorted inside them.

Joins, aggregations and keep-first steps on the cluster key find equal keys in one bucket and need no
shuffle; two tables join that way if they have the same number of buckets. A bucket is read by one
task, so a key that holds a large part of the rows makes a heavy bucket. `read_clustered` looks at
the files' sizes and reads a table with a heavy bucket as plain files, where adaptive execution can
shuffle and split it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BUCKET = re.compile(r".*_(\d+)(?:\..*)?$")


def write_clustered(df: DataFrame, name: str, keys: list[str], buckets: int, path: str,
                    files_per_bucket: int = 1) -> None:
    """Overwrite a catalog table, its files below `path`, in `buckets` buckets by `keys`, sorted by them.

    One shuffle brings each bucket to one task, or to `files_per_bucket` tasks where keys are hot.
    """
    if files_per_bucket > 1:
        bucket = F.pmod(F.hash(*keys), F.lit(buckets))
        part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        rows = df.repartition(buckets * files_per_bucket, bucket, part)
    else:
        rows = df.repartition(buckets, *keys)
    (rows.write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes per bucket number, from one listing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    sizes: dict[int, int] = {}
    for status in hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path):
        found = _BUCKET.match(status.getPath().getName())
        if found and status.isFile() and not status.getPath().getName().startswith((".", "_")):
            sizes[int(found[1])] = sizes.get(int(found[1]), 0) + status.getLen()
    return sizes


def read_clustered(spark: SparkSession, name: str, most_share: float = 4.0,
                   least_bytes: int = 256 << 20) -> DataFrame:
    """A clustered table, by bucket; or as plain files, if its largest bucket has over `least_bytes`
    and over `most_share` times the bytes of an average one."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    path, buckets = described["Location"], int(described["Num Buckets"])
    sizes = bucket_bytes(spark, path)
    most = max(sizes.values(), default=0)
    if most > least_bytes and most > most_share * sum(sizes.values()) / buckets:
        return spark.read.schema(spark.table(name).schema).parquet(path)
    return spark.table(name)
