"""CSV loads that keep what they cannot read.

A plain load with a declared schema turns a malformed field into NULL, so a bad line looks like a line with a gap.
Here such a line is no row at all: it goes to a second output as it stands, with its file. Loaded
and rejected lines are written in one pass over the files, and together they are all lines.

A line is rejected if a field does not convert to its declared type, or if it has fewer or more
fields than declared. Empty fields are NULL and fine. Blank lines are no lines. Quoted line breaks
are not supported, so that large files can be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = "_rejected_line"
_FLAG = "rejected"


@dataclass(frozen=True)
class Load:
    """What a load has written: rows, and the lines that are none."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _read(self, flag: str, schema: T.StructType) -> DataFrame:
        # the folder of a kind is missing where there was no such line
        return (self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_FLAG, T.StringType())]))
                .parquet(self.path).where(F.col(_FLAG) == flag).drop(_FLAG))

    def rows(self) -> DataFrame:
        """Loaded rows, typed, with the name of their file."""
        return self._read("no", T.StructType([*self.schema.fields, T.StructField("filename", T.StringType())]))

    def rejects(self) -> DataFrame:
        """Rejected lines as text, with the name of their file."""
        fields = [T.StructField(_LINE, T.StringType()), T.StructField("filename", T.StringType())]
        return self._read("yes", T.StructType(fields)).withColumnRenamed(_LINE, "line")

    def audit(self) -> DataFrame:
        """Lines per file: loaded, rejected and the share of the latter, from two columns of the output."""
        schema = T.StructType([T.StructField("filename", T.StringType()), T.StructField(_FLAG, T.StringType())])
        counted = (self.spark.read.schema(schema).parquet(self.path).groupBy("filename")
                   .agg(F.count_if(F.col(_FLAG) == "no").alias("n_loaded"),
                        F.count_if(F.col(_FLAG) == "yes").alias("n_rejected")))
        return counted.withColumn("share_rejected", F.col("n_rejected") / (F.col("n_loaded") + F.col("n_rejected")))


class RejectedError(RuntimeError):
    """More lines than allowed could not be read."""


def load_csv(spark: SparkSession, source: str, schema: T.StructType, path: str, header: bool = True,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss", most_share: float = 1.0) -> Load:
    """Load CSV files (also gzipped) into Parquet below `path`, rows and rejected lines apart.

    With `most_share` a load with a larger share of rejected lines is an error; what it has written
    stays for inspection.
    """
    clash = {_LINE, _FLAG, "filename"} & {f.name.lower() for f in schema.fields}
    if clash:
        raise ValueError(f"the load's own columns have these names: {sorted(clash)}")
    declared = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields],
                             T.StructField(_LINE, T.StringType())])
    # all columns are read, since a line is only parsed as far as columns are asked for
    rows = (spark.read.schema(declared).option("header", header).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
            .option("timestampFormat", timestamp_format).csv(source))
    (rows.select("*", F.col("_metadata.file_name").alias("filename"),
                 F.when(F.col(_LINE).isNull(), "no").otherwise("yes").alias(_FLAG))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_FLAG).parquet(path))
    load = Load(spark, path, schema)
    if most_share < 1:
        found = load.audit().agg(F.sum("n_loaded").alias("good"), F.sum("n_rejected").alias("bad")).head()
        good, bad = found["good"] or 0, found["bad"] or 0
        if bad > most_share * (good + bad):
            raise RejectedError(f"{bad} of {good + bad} lines rejected: see {path}")
    return load
