"""Data-quality checks.

A check is a function from tables to the rows that break the rule; it passes when there are none.
Every check takes `where`, which restricts the tested table first. Checks whose failures are one
condition per row are `row_rule`s, so that a suite can evaluate all of them in one scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import filtered_columns, quoted
from .joins import orphans
from .neighbours import counted_neighbours
from .sets import one_sided_rows

Condition = str | Column | None


def _filtered(df: DataFrame, where: Condition) -> DataFrame:
    return df if where is None else df.where(where)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _bound(value) -> Column:
    """A bound is a literal number, or a column or expression given as text."""
    return F.expr(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)


# --- rules on single rows: a Column that is TRUE where the row fails ---

def fails_not_null(column: str) -> Column:
    return _col(column).isNull()


def fails_not_empty(column: str, trim_whitespace: bool = True) -> Column:
    text = F.trim(_col(column)) if trim_whitespace else _col(column)
    return text == ""


def fails_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """NULL values and NULL bounds pass."""
    value, failed = _col(column), F.lit(False)
    if min_value is not None:
        low = _bound(min_value)
        failed = failed | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = _bound(max_value)
        failed = failed | ~(value <= high if inclusive else value < high)
    return failed


def fails_expression(expression: str, column: str | None = None) -> Column:
    """Rows where the expression is false; NULL passes."""
    return ~F.expr(f"{column} {expression}" if column else expression)


# --- checks ---

def rows_where(df: DataFrame, failing: Column, where: Condition = None) -> DataFrame:
    return _filtered(df, where).where(failing)


def not_null(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    return rows_where(df, fails_not_null(column), where)


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True,
                     where: Condition = None) -> DataFrame:
    text = F.trim(_col(column)) if trim_whitespace else _col(column)
    return _filtered(df, where).select(text.alias(column)).where(_col(column) == "")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   inclusive: bool = True, where: Condition = None) -> DataFrame:
    return rows_where(df, fails_range(column, min_value, max_value, inclusive), where)


def expression_is_true(df: DataFrame, expression: str, column: str | None = None,
                       where: Condition = None) -> DataFrame:
    return rows_where(df, fails_expression(expression, column), where)


def unique(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    return (_filtered(df, where).where(_col(column).isNotNull())
            .groupBy(_col(column).alias("unique_field")).agg(F.count("*").alias("n_records"))
            .where("n_records > 1"))


def unique_combination(df: DataFrame, columns: list[str], where: Condition = None) -> DataFrame:
    """Combinations that occur more than once."""
    return (_filtered(df, where).groupBy(*columns).agg(F.count("*").alias("n_records"))
            .where("n_records > 1").select(*columns))


def accepted_values(df: DataFrame, column: str, values: list, where: Condition = None) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    return (_filtered(df, where).groupBy(_col(column).alias("value_field"))
            .agg(F.count("*").alias("n_records")).where(~F.col("value_field").isin(values)))


def not_accepted_values(df: DataFrame, column: str, values: list,
                        where: Condition = None) -> DataFrame:
    """Forbidden values that occur."""
    return (_filtered(df, where).select(_col(column).alias("value_field"))
            .where(F.col("value_field").isin(values)).distinct())


def relationships(df: DataFrame, column: str, to: DataFrame, to_field: str,
                  from_condition: Condition = None, to_condition: Condition = None,
                  where: Condition = None) -> DataFrame:
    """Non-NULL keys without a row in the other table, one output row per tested row."""
    return (orphans(_filtered(df, where), to, column, to_field, from_condition, to_condition)
            .select(_col(column).alias("id")))


def not_constant(df: DataFrame, column: str, group_by: list[str] | None = None,
                 where: Condition = None) -> DataFrame:
    """Groups with exactly one distinct non-NULL value.

    min = max says the same as a distinct count of one, without shuffling the values.
    """
    value = _col(column)
    return (_filtered(df, where).groupBy(*(group_by or []))
            .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
            .where("_low = _high").select(*(group_by or []), F.lit(1).cast("bigint").alias("filler_column")))


def at_least_one(df: DataFrame, column: str, group_by: list[str] | None = None,
                 where: Condition = None) -> DataFrame:
    """Groups (or the table) without any non-NULL value."""
    rows, value = _filtered(df, where), _col(column)
    if not group_by:
        rows = rows.where(value.isNotNull()).limit(1)
    return (rows.groupBy(*(group_by or [])).agg(F.count(value).alias("filler_column"))
            .where("filler_column = 0"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: list[str] | None = None, where: Condition = None) -> DataFrame:
    share = F.count(_col(column)) / F.count("*")
    return (_filtered(df, where).groupBy(*(group_by or []))
            .agg(share.alias("not_null_proportion"))
            .where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)))


def recency(df: DataFrame, column: str, datepart: str, interval: int, now: datetime | str | Column,
            ignore_time: bool = False, group_by: list[str] | None = None,
            where: Condition = None) -> DataFrame:
    """Groups whose newest value is older than `now - interval`; `now` is given by the caller."""
    moment = now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")
    as_type = "date" if ignore_time else "timestamp"
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), moment).cast(as_type)
    return (_filtered(df, where).groupBy(*(group_by or []))
            .agg(F.max(_col(column)).cast(as_type).alias("most_recent"))
            .withColumn("threshold", threshold).where("most_recent < threshold"))


def _counts_side_by_side(ours: DataFrame, theirs: DataFrame, group_by: list[str], our_count: str,
                         their_count: str) -> DataFrame:
    """Rows per group in either table, from one grouped pass over both.

    A group of one table only has no count for the other, and a table without rows has none at all.
    Groups with a NULL never belong together, so they keep their table as part of the key.
    """
    def marked(df: DataFrame, mine: bool) -> DataFrame:
        return df.select(F.lit(mine).alias("_mine"), *[_col(c).alias(f"_key_{i}") for i, c in enumerate(group_by)])

    keys = [f"_key_{i}" for i in range(len(group_by))]
    rows = marked(ours, True).unionByName(marked(theirs, False))
    any_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys], F.lit(False))
    grouped = (rows.groupBy(F.when(any_null, F.col("_mine")).alias("_apart"), *keys)
               .agg(F.count_if("_mine").alias("_ours"), F.count_if(~F.col("_mine")).alias("_theirs")))
    ours_there, theirs_there = F.col("_ours") > 0, F.col("_theirs") > 0
    return grouped.select(
        *[F.when(ours_there, F.col(k)).alias(f"{c}_a") for k, c in zip(keys, group_by)],
        F.when(ours_there, F.col("_ours")).alias(our_count),
        *[F.when(theirs_there, F.col(k)).alias(f"{c}_b") for k, c in zip(keys, group_by)],
        F.when(theirs_there, F.col("_theirs")).alias(their_count))


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None,
                   where: Condition = None) -> DataFrame:
    """Row counts of both tables per group with their difference.

    Fails by the sum of `diff_count`. A group on one side only has no difference and passes.
    """
    counts = _counts_side_by_side(_filtered(df, where), compare, group_by or [], "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None,
                    where: Condition = None) -> DataFrame:
    """As `equal_rowcount`; fails by the surplus, or by one where counts are equal."""
    counts = _counts_side_by_side(_filtered(df, where), compare, group_by or [],
                                  "count_our_model", "count_comparison_model")
    surplus = F.col("count_our_model") - F.col("count_comparison_model")
    return counts.withColumn("row_count_delta", F.when(surplus >= 0, F.greatest(surplus, F.lit(1)))
                             .otherwise(0).cast("bigint"))


def equality(df: DataFrame, compare: DataFrame, compare_columns: list[str] | None = None,
             exclude_columns: list[str] | None = None, precision: int | None = None,
             where: Condition = None) -> DataFrame:
    """Rows in one table only, as sets. With a precision, fractional numbers are rounded first."""
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        wanted = {c.lower() for c in compare_columns}
        columns = [c for c in df.columns if c.lower() in wanted]
    else:
        columns = filtered_columns(df, exclude_columns)
        others = filtered_columns(compare, exclude_columns)
        if {c.lower() for c in columns} != {c.lower() for c in others}:
            raise ValueError("the tables do not have the same columns; use compare_columns or "
                             "exclude_columns")
    fractional = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))}

    def projected(rows: DataFrame) -> DataFrame:
        return rows.select(*[
            F.round(quoted(c).cast("decimal(38,9)"), precision).alias(c)
            if precision is not None and c in fractional else quoted(c).alias(c) for c in columns])

    return one_sided_rows(projected(_filtered(df, where)), projected(compare))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, to_field: str,
                         where: Condition = None) -> DataFrame:
    """Values whose row counts differ between the tables, with the count of each side that has it."""
    def tagged(rows: DataFrame, name: str, side: int) -> DataFrame:
        return rows.select(_col(name).alias("value_field"), F.lit(side).alias("_side"))

    both = tagged(_filtered(df, where), column, 0).union(tagged(to, to_field, 1))
    counts = both.groupBy("value_field").agg(
        F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b"))
    sides = F.explode(F.filter(F.array("_a", "_b"), lambda n: n > 0))
    return counts.where("_a <> _b").select("value_field", sides.alias("num_rows"))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: list[str] | None = None, where: Condition = None) -> DataFrame:
    """Values that are not the previous value plus the interval.

    Returns each failing (value, previous value) pair once, with `n_rows` rows that show it. The
    first value of a group has no previous value and passes.
    """
    group, value, previous = group_by or [], F.col(column), f"previous_{column}"

    def breaks(prev: Column) -> Column:
        if datepart:
            following = F.timestamp_add(datepart.upper(), F.lit(interval), prev.cast("timestamp"))
            return value.cast("timestamp") != following
        return value != prev + interval

    rows = _filtered(df, where).select(*group, column).where(value.isNotNull())
    linked = counted_neighbours(rows, group, [column], column, following=False, name=previous,
                                wanted=lambda prev: breaks(prev) | (F.col("n_rows") > 1))
    # the first of n equal rows follows the smaller value, the other n - 1 follow an equal one
    pairs = F.array(F.struct(F.col(previous).alias("prev"), F.lit(1).cast("bigint").alias("n")),
                    F.struct(value.alias("prev"), (F.col("n_rows") - 1).alias("n")))
    return (linked.select(*group, column, F.inline(pairs).alias(previous, "n_rows"))
            .where((F.col("n_rows") > 0) & breaks(F.col(previous))))


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str,
                              partition_by: list[str] | None = None, gaps: str = "allowed",
                              zero_length_range_allowed: bool = False,
                              where: Condition = None) -> DataFrame:
    """Ranges that are not properly ordered or that touch the next range against the rule.

    `gaps`: allowed (upper <= next lower), not_allowed (upper = next lower), required
    (upper < next lower). Returns each failing range once, with `n_rows` rows that fail.
    """
    rules = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n,
             "required": lambda u, n: u < n}
    if gaps not in rules:
        raise ValueError("gaps must be allowed, not_allowed or required")
    group, low, high = partition_by or [], F.col(lower), F.col(upper)
    ordered = low <= high if zero_length_range_allowed else low < high

    def fails(next_low: Column, is_last: Column) -> Column:
        # a missing bound or a NULL comparison breaks the rule, except for the last range's end
        in_order = F.coalesce(ordered, F.lit(False))
        fits_next = F.coalesce(rules[gaps](high, next_low), is_last)
        return ~(in_order & fits_next)

    rows = _filtered(df, where).select(*group, lower, upper)
    next_lower, n_rows = F.col("next_lower"), F.col("n_rows")
    linked = counted_neighbours(rows, group, [lower, upper], lower, following=True, name="next_lower",
                                wanted=lambda nxt: fails(nxt, F.lit(False)) | (n_rows > 1))
    # the last of n equal rows meets the next range, the other n - 1 meet an equal one
    one = F.lit(1).cast("bigint")
    cases = F.array(
        F.struct(next_lower.alias("nxt"), one.alias("n"), next_lower.isNull().alias("last")),
        F.struct(low.alias("nxt"), (n_rows - 1).alias("n"), F.lit(False).alias("last")))
    return (linked.select(*group, lower, upper, F.inline(cases).alias("next_lower", "n_rows", "_last"))
            .where((n_rows > 0) & fails(next_lower, F.col("_last"))).drop("_last"))


def schema_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that are missing, not declared, or of another type."""
    def flat(schema: T.StructType) -> dict[str, str]:
        return {f.name.lower(): f.dataType.simpleString() for f in schema.fields}

    actual, declared = flat(df.schema), flat(contract)
    problems = [(name, declared.get(name), actual.get(name))
                for name in sorted({*actual, *declared}) if actual.get(name) != declared.get(name)]
    return df.sparkSession.createDataFrame(
        problems, "column_name string, declared_type string, actual_type string")


def source_freshness(df: DataFrame, loaded_at: str, now: datetime | str | Column,
                     warn_after_hours: int = 6, error_after_hours: int = 24) -> DataFrame:
    """Age of the newest load against the warning and error limits."""
    moment = now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")
    age = (F.unix_seconds(moment) - F.unix_seconds(F.col("max_loaded_at"))) / F.lit(3600.0)
    status = (F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_after_hours), "error")
              .when(F.col("age_hours") > warn_after_hours, "warn").otherwise("pass"))
    return (df.agg(F.max(loaded_at).alias("max_loaded_at"))
            .withColumn("age_hours", age).withColumn("status", status))


# --- suites ---

@dataclass(frozen=True)
class Check:
    """A named check of a suite.

    Give `row_rule` (a failing condition on the rows of `table`, restricted by `where`) or
    `failing` (a function that returns the failing rows). `failures` overrides how they are counted. `warn_if` and `error_if`
    compare the number of failures, e.g. `"> 10"`; with severity `warn` a check never errors.
    """

    name: str
    table: DataFrame | None = None
    row_rule: Column | None = None
    failing: Callable[[], DataFrame] | None = None
    failures: Column = field(default_factory=lambda: F.count("*"))
    where: Condition = None
    severity: str = "error"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"

    def __post_init__(self):
        if (self.row_rule is None) == (self.failing is None):
            raise ValueError("give either row_rule or failing")
        if self.row_rule is not None and self.table is None:
            raise ValueError("a row rule needs its table")
        if self.failing is not None and self.where is not None:
            raise ValueError("pass where to the check itself, inside failing")
        if self.severity not in ("warn", "error"):
            raise ValueError("severity must be warn or error")


def _fold_row_rules(table: DataFrame, checks: list[Check]) -> DataFrame:
    """All row rules of one table as one aggregate, then one row per check."""
    def condition(check: Check) -> Column:
        if check.where is None:
            return check.row_rule
        where = F.expr(check.where) if isinstance(check.where, str) else check.where
        return where & check.row_rule

    counts = table.agg(*[F.count_if(condition(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = F.array(*[F.struct(F.lit(c.name).alias("name"), F.col(f"c{i}").alias("failures"))
                      for i, c in enumerate(checks)])
    return counts.select(F.inline(pairs))


def run_suite(checks: list[Check]) -> DataFrame:
    """One row per check: name, failures, severity, status (pass, warn or error)."""
    by_table: dict[int, list[Check]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if check.row_rule is not None:
            by_table.setdefault(id(check.table), []).append(check)
        else:
            count = F.coalesce(check.failures, F.lit(0)).cast("bigint").alias("failures")
            parts.append(check.failing().agg(count).select(F.lit(check.name).alias("name"), "failures"))
    parts += [_fold_row_rules(group[0].table, group) for group in by_table.values()]
    if not parts:
        raise ValueError("the suite has no checks")
    counted = reduce(DataFrame.union, parts)

    def per_check(value: Callable[[Check], Column]) -> Column:
        first, *rest = checks
        return reduce(lambda c, k: c.when(F.col("name") == k.name, value(k)), rest,
                      F.when(F.col("name") == first.name, value(first)))

    def status(check: Check) -> Column:
        warned = F.when(F.expr(f"failures {check.warn_if}"), "warn").otherwise("pass")
        if check.severity == "warn":
            return warned
        return F.when(F.expr(f"failures {check.error_if}"), "error").otherwise(warned)

    return counted.select("name", "failures", per_check(lambda c: F.lit(c.severity)).alias("severity"),
                          per_check(status).alias("status"))
