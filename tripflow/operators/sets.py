"""Unions of unlike tables and set comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SOURCE_COLUMN
from .columns import quoted


def union_relations(relations: dict[str, DataFrame], column_override: dict[str, str] | None = None,
                    include: list[str] | None = None, exclude: list[str] | None = None,
                    source_column_name: str | None = SOURCE_COLUMN,
                    where: str | None = None, try_casts: bool = False) -> DataFrame:
    """UNION ALL over the superset of columns.

    A column missing from a relation is a typed NULL. The first relation that has a column decides
    its type unless overridden; other relations are cast to it. `where` applies to every relation
    before the union, and `source_column_name` holds the relation's name.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    if not relations:
        raise ValueError("no relation given")
    included = {name.lower() for name in include or []}
    excluded = {name.lower() for name in exclude or []}

    superset: dict[str, str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            lowered = field.name.lower()
            if lowered in excluded or (included and lowered not in included):
                continue
            superset.setdefault(field.name, field.dataType.simpleString())
    if not superset:
        raise ValueError("no column left to union")
    types = {**superset, **{k: v for k, v in (column_override or {}).items() if k in superset}}

    def aligned(name: str, df: DataFrame) -> DataFrame:
        present = set(df.columns)

        def column(col: str, data_type: str) -> Column:
            source = quoted(col) if col in present else F.lit(None)
            cast = source.try_cast if try_casts else source.cast
            return cast(data_type).alias(col)

        rows = df.where(where) if where else df
        source = [F.lit(name).alias(source_column_name)] if source_column_name else []
        return rows.select(*source, *[column(c, t) for c, t in types.items()])

    return reduce(DataFrame.unionByName, [aligned(n, df) for n, df in relations.items()])


def one_sided_rows(a: DataFrame, b: DataFrame, tag: str = "which_diff") -> DataFrame:
    """EXCEPT (distinct) in both directions at once, tagged `a_minus_b` or `b_minus_a`.

    One grouped pass instead of two EXCEPTs: copies collapse before the shuffle, and NULLs compare
    equal as in EXCEPT.
    """
    names = a.columns
    left = a.select(*[quoted(n) for n in names], F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.toDF(*names).select(*[quoted(n) for n in names], F.lit(0).alias("_a"),
                                  F.lit(1).alias("_b"))
    return (left.union(right).groupBy(*[quoted(n) for n in names])
            .agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
            .where("_a + _b = 1")
            .select(F.when(F.col("_a") == 1, "a_minus_b").otherwise("b_minus_a").alias(tag),
                    *[quoted(n) for n in names]))
