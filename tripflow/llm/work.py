"""Intermediate tables in the shared work folder, and the settings the operators run under."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import configure, work_dir
from ..sources.writers import delete_path

#: Folders of the tables stored inside the innermost `private_tables`, if there is one.
_private: ContextVar[list[str] | None] = ContextVar("private", default=None)


def ready(spark: SparkSession) -> SparkSession:
    """The package's settings, and Arrow batches that stay small when texts are long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the work folder and read it back: the lineage ends here, and a lost
    executor costs no earlier work."""
    path = work_dir(df.sparkSession, label)
    folders = _private.get()
    if folders is not None:
        folders.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def private_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end. What is to last must be stored outside, from
    plans that have been run by then: see `kept_beyond`."""
    folders: list[str] = []
    token = _private.set(folders)
    try:
        yield
    finally:
        _private.reset(token)
        for path in folders:
            delete_path(spark, path)


def kept_beyond(df: DataFrame, label: str) -> DataFrame:
    """Store a result so that it outlives the `private_tables` around it."""
    token = _private.set(None)
    try:
        return stored(df, label)
    finally:
        _private.reset(token)


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
