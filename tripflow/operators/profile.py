"""A profile of every column in one scan.

`column_sketches` is one aggregate with a few mergeable parts per column: counts, least and greatest
value, sum, and sketches of the distinct values (HyperLogLog), the quantiles (KLL) and the
commonest values. Its rows, one per group such as a day, can be stored and merged later, so the
profile of a grown table reads the new part only. `profile` merges them and turns columns into rows.

Counts, least and greatest value are exact. Distinct counts are within 4.9 % (three standard errors of 2^12
registers), quantiles within 1.7 % of the rows by rank (K = 200), at a confidence of 99 %. A commonest value's
count is exact while a column has fewer than `tracked` values per map task, and low by a bounded amount beyond that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of the distinct sketches as a power of two, and values that the top-value sketch keeps.
LG, TRACKED = 12, 1000
_PARTS = ("n", "blank", "distinct", "ranks", "total", "least", "most", "top")


def _parts(field: T.StructField, tracked: int) -> dict[str, Column]:
    """The mergeable parts of a column's profile."""
    column, numeric = F.col(f"`{field.name}`"), isinstance(field.dataType, T.NumericType)
    text, plain = isinstance(field.dataType, T.StringType), isinstance(field.dataType, T.AtomicType)
    number = column.cast("double")
    # a number that is none (NaN, infinite) has no place among ranks and sums
    number = F.when((number > float("-inf")) & (number < float("inf")), number)
    nothing = F.max(F.lit(None).cast("string"))
    whole = F.when(column.isNotNull(), F.xxhash64(column))
    return {"n": F.count(column),
            "blank": F.count_if(F.trim(column) == "") if text else F.sum(F.lit(None).cast("bigint")),
            "distinct": F.hll_sketch_agg(whole, LG),
            "ranks": F.kll_sketch_agg_double(number) if numeric else F.max(F.lit(None).cast("binary")),
            "total": F.sum(number) if numeric else F.max(F.lit(None).cast("double")),
            "least": F.min(column) if plain else nothing, "most": F.max(column) if plain else nothing,
            "top": F.call_function("approx_top_k_accumulate", column.cast("string") if plain else whole.cast("string"),
                                   F.lit(tracked))}


def column_sketches(df: DataFrame, by: list[Column | str] | None = None, columns: list[str] | None = None,
                    tracked: int = TRACKED) -> DataFrame:
    """One row (per group `by`) with the mergeable parts of every column's profile."""
    wanted = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not wanted:
        raise ValueError("there is no column to look at")
    made = []
    for i, field in enumerate(wanted):
        about = {"column": field.name, "type": field.dataType.simpleString()}
        made += [part.alias(f"p{i}_{name}", metadata=about) for name, part in _parts(field, tracked).items()]
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n_rows"), *made)


def _merged(sketches: DataFrame) -> DataFrame:
    """All groups as one row."""
    merge = {"n": F.sum, "blank": F.sum, "distinct": F.hll_union_agg, "total": F.sum, "least": F.min, "most": F.max,
             "top": lambda c: F.call_function("approx_top_k_combine", F.col(c))}
    made = []
    for field in sketches.schema.fields:
        if "column" in field.metadata:
            kind = field.name.partition("_")[2]
            numeric = kind == "ranks" and _is_numeric(field.metadata["type"])
            fold = merge.get(kind, F.kll_merge_agg_double if numeric else F.max)
            made.append(fold(field.name).alias(field.name, metadata=field.metadata))
    return sketches.agg(F.sum("n_rows").alias("n_rows"), *made)


def _is_numeric(name: str) -> bool:
    return name in ("tinyint", "smallint", "int", "bigint", "float", "double") or name.startswith("decimal")


def profile(sketches: DataFrame, top: int = 5, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Stored sketches to a row per column: (position, column, type, n_rows, n_null, n_blank, n_distinct, least,
    most, mean, quantiles, top_values); values are shown as text, parts that a type does not have are NULL."""
    row, found = _merged(sketches), []
    fields = [f for f in row.schema.fields if f.name.endswith("_n") and "column" in f.metadata]
    for i, field in enumerate(fields):
        name, kind = field.metadata["column"], field.metadata["type"]
        part = {p: F.col(f"p{i}_{p}") for p in _PARTS}
        ranks, none = F.lit(None).cast("array<double>"), F.lit(None).cast("double")
        if _is_numeric(kind):
            there = part["total"].isNotNull()
            ranks = F.when(there, F.kll_sketch_get_quantile_double(part["ranks"], F.array(*map(F.lit, quantiles))))
            none = part["total"] / F.when(there, F.kll_sketch_get_n_double(part["ranks"]))
        commonest = F.call_function("approx_top_k_estimate", part["top"], F.lit(top))
        found.append(F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col("n_rows").alias("n_rows"),
            (F.col("n_rows") - part["n"]).alias("n_null"), part["blank"].alias("n_blank"),
            F.hll_sketch_estimate(part["distinct"]).alias("n_distinct"), part["least"].cast("string").alias("least"),
            part["most"].cast("string").alias("most"), none.alias("mean"), ranks.alias("quantiles"),
            F.filter(commonest, lambda x: x["item"].isNotNull()).alias("top_values")))
    # the one row is merged before it is turned, so that parts are not worked out once per column
    return row.select(F.inline(F.array(*found)))


def profile_table(df: DataFrame, columns: list[str] | None = None, **options) -> DataFrame:
    """The profile of a table's columns, from one scan."""
    return profile(column_sketches(df, columns=columns), **options)


def profile_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two profiles side by side: shares of NULLs and distinct counts that have moved."""
    share = lambda side: F.col(f"{side}.n_null") / F.nullif(F.col(f"{side}.n_rows"), F.lit(0))
    same = reduce(lambda a, b: a & b, [F.col("b.column").eqNullSafe(F.col("a.column"))])
    return (before.alias("b").join(after.alias("a"), same, "full").select(
        F.coalesce("a.column", "b.column").alias("column"), F.col("b.type").alias("type_before"),
        F.col("a.type").alias("type_after"), share("b").alias("null_share_before"), share("a").alias("null_share_after"),
        F.col("b.n_distinct").alias("n_distinct_before"), F.col("a.n_distinct").alias("n_distinct_after")))
