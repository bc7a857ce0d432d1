"""Operators over the column list of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import empty_to_null


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def filtered_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Column names without the excluded ones; names compare case-insensitively."""
    dropped = {name.lower() for name in exclude or []}
    return [name for name in df.columns if name.lower() not in dropped]


def star(df: DataFrame, exclude: list[str] | None = None, prefix: str = "",
         suffix: str = "", relation_alias: str | None = None) -> list[Column]:
    """All columns but the excluded ones, optionally renamed with a prefix and suffix."""
    def column(name: str) -> Column:
        source = F.col(f"{relation_alias}.`{name}`") if relation_alias else quoted(name)
        return source.alias(f"{prefix}{name}{suffix}")

    columns = [column(name) for name in filtered_columns(df, exclude)]
    if not columns:
        raise ValueError("all columns are excluded")
    return columns


def nullcheck(df: DataFrame) -> list[Column]:
    """The table's columns, with empty text turned to NULL."""
    return [empty_to_null(quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
            else quoted(f.name) for f in df.schema.fields]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def unpivot(df: DataFrame, exclude: list[str] | None = None, remove: list[str] | None = None,
            cast_to: str = "string", field_name: str = "field_name",
            value_name: str = "value") -> DataFrame:
    """Columns to rows in one scan. `exclude` columns are kept on every row, `remove` columns are
    dropped, all others become (field, value) rows with the value cast to one type."""
    exclude, remove = exclude or [], remove or []
    melted = filtered_columns(df, exclude + remove)
    if not melted:
        raise ValueError("no column left to unpivot")
    names = {name.lower(): name for name in df.columns}
    kept = [names[name.lower()] for name in exclude]
    types = {f.name: f.dataType for f in df.schema.fields}

    def value(name: str) -> Column:
        source = quoted(name)
        if isinstance(types[name], T.BooleanType):
            source = source.cast("string")
        return source.cast(cast_to).alias(name)

    projected = df.select(*[quoted(n) for n in kept], *[value(n) for n in melted])
    return projected.unpivot([quoted(n) for n in kept], [quoted(n) for n in melted],
                             field_name, value_name)


def rename_common(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename feed-specific columns to the common names; columns not present are ignored."""
    return df.withColumnsRenamed(mapping)
