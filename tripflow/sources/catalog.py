"""Tables and views by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _like(pattern: str) -> re.Pattern:
    """SQL LIKE pattern, case-insensitive."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def _quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def relations_by_pattern(spark: SparkSession, table_pattern: str, exclude: str = "",
                         database: str | None = None) -> dict[str, DataFrame]:
    """Tables whose name matches a LIKE pattern, in name order.

    Without a database these are the current one's tables, by name, and the temporary views. A
    database is a LIKE pattern too: its tables come by qualified name, and temporary views, which
    belong to none, stay out.
    """
    wanted, unwanted = _like(table_pattern), _like(exclude)

    def matches(name: str) -> bool:
        return bool(wanted.fullmatch(name)) and not (exclude and unwanted.fullmatch(name))

    if database is None:
        names = sorted({t.name for t in spark.catalog.listTables()})
        return {name: spark.table(_quoted(name)) for name in names if matches(name)}
    found = {}
    for place in sorted(d.name for d in spark.catalog.listDatabases() if _like(database).fullmatch(d.name)):
        names = sorted(t.name for t in spark.catalog.listTables(_quoted(place)) if not t.isTemporary)
        found.update({f"{place}.{name}": spark.table(_quoted(place, name)) for name in names if matches(name)})
    return found


def relations_by_prefix(spark: SparkSession, prefix: str, exclude: str = "",
                        database: str | None = None) -> dict[str, DataFrame]:
    return relations_by_pattern(spark, f"{prefix}%", exclude, database)


def table_or(spark: SparkSession, name: str, default: DataFrame) -> DataFrame:
    """A table by name, or the default where there is none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else default
