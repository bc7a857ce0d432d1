"""JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._cols import as_col


def decode_json(text: Column | str, schema: T.StructType) -> Column:
    """Text to a struct; a record that does not parse gives a struct of NULLs."""
    return F.from_json(as_col(text), schema)


def encode_json(*fields: Column | str) -> Column:
    """The fields as one JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*map(as_col, fields)))


def project_with_default(text: Column | str, keys: list[str], default: str = "N/A") -> list[Column]:
    """Chosen top-level keys of a JSON object as text columns, `default` where a key is missing."""
    text = as_col(text)
    return [F.coalesce(F.get_json_object(text, f"$['{key}']"), F.lit(default)).alias(key)
            for key in keys]
