"""Session defaults and the shared work folder.

Only runtime SQL settings live here, so that `configure` can be applied to a session somebody
else built. Master, memory and executor counts belong to the submit command.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings results depend on.
_SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that keep plans healthy on large, skewed inputs.
_SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even if that costs a later stage its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge session windows of a stream on the map side, so that a hot key travels as few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# State store for streams whose keyed state outgrows the executor heap.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's runtime settings to an existing session."""
    for key, value in {**_SEMANTICS, **_SCALE}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "tripflow", extra: dict[str, str] | None = None) -> SparkSession:
    """Build a session; master and resources come from spark-submit unless given in `extra`."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**_SEMANTICS, **_SCALE, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, stream checkpoints and results.

    The cluster names it in `spark.checkpoint.dir`. Where it is unset a local master gets a
    temporary folder; on a cluster an unset folder is an error, because executors do not share
    local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tripflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
