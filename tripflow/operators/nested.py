"""Nested JSON to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._cols import as_col


def json_map_to_rows(df: DataFrame, json: str | Column, value_schema: T.StructType, key_name: str,
                     keep: list[str] | None = None) -> DataFrame:
    """`{key: {..}, ..}` to one row per key, with the key as a column; values that are not objects
    are skipped."""
    # values stay raw JSON text first, so that a non-object value does not spoil its neighbours
    texts = F.from_json(as_col(json), T.MapType(T.StringType(), T.StringType()))
    entries = df.select(*(keep or []), F.explode(texts).alias(key_name, "_text"))
    objects = entries.where(F.ltrim("_text").startswith("{"))
    parsed = objects.withColumn("_value", F.from_json("_text", value_schema))
    return parsed.select(*(keep or []), key_name, "_value.*")


def decode_or_reject(df: DataFrame, json: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Decoded records and, separately, the rows whose text is not valid JSON for the schema."""
    with_reject = T.StructType([*schema.fields, T.StructField("_rejected", T.StringType())])
    others = [c for c in df.columns if c != json]
    parsed = df.withColumn("_record", F.from_json(
        json, with_reject, {"columnNameOfCorruptRecord": "_rejected"}))
    bad = F.col("_record").isNull() | F.col("_record._rejected").isNotNull()
    good = parsed.where(~bad).select(*others, *[F.col(f"_record.{f.name}") for f in schema.fields])
    return good, parsed.where(bad).select(*df.columns)
