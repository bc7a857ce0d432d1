"""Each check with a passing and a failing input."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import row_set, rows_of
from tripflow.operators import quality as dq
from tripflow.schemas import declared


def passes(df) -> bool:
    return df.count() == 0


def test_unique(frame):
    df = frame("a int", [(1,), (2,), (2,), (None,), (None,)])
    assert rows_of(dq.unique(df, "a")) == [(2, 2)]
    assert passes(dq.unique(df, "a", where="a <> 2"))


def test_not_null(frame):
    df = frame("a int, b int", [(1, 1), (None, 2)])
    assert rows_of(dq.not_null(df, "a")) == [(None, 2)]
    assert passes(dq.not_null(df, "b"))


def test_accepted_values(frame):
    df = frame("a string", [("x",), ("y",), ("y",), (None,)])
    assert rows_of(dq.accepted_values(df, "a", ["x"])) == [("y", 2)]
    assert passes(dq.accepted_values(df, "a", ["x", "y"]))


def test_not_accepted_values(frame):
    df = frame("city string", [("Barcelona",), ("London",), ("Madrid",), ("Madrid",)])
    assert rows_of(dq.not_accepted_values(df, "city", ["Madrid", "Berlin"])) == [("Madrid",)]
    assert passes(dq.not_accepted_values(df, "city", ["Berlin"]))


def test_relationships(frame):
    child, parent = frame("id int", [(1,), (4,), (4,), (None,)]), frame("id int", [(1,), (2,), (None,)])
    assert rows_of(dq.relationships(child, "id", parent, "id")) == [(4,), (4,)]
    assert passes(dq.relationships(child, "id", parent, "id", from_condition="id <> 4"))
    assert not passes(dq.relationships(child, "id", parent, "id", "id <> 4", to_condition="id <> 1"))


def test_not_constant(frame):
    df = frame("field int, g string", [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, "c")])
    assert passes(dq.not_constant(df, "field"))
    assert rows_of(dq.not_constant(df, "field", group_by=["g"])) == [("a", 1)]
    assert rows_of(dq.not_constant(df, "field", where="field = 1")) == [(1,)]


def test_at_least_one(frame):
    df = frame("field string, value int", [("a", 1), ("a", None), ("b", None)])
    assert passes(dq.at_least_one(df, "value"))
    assert rows_of(dq.at_least_one(df, "value", group_by=["field"])) == [("b", 0)]
    assert rows_of(dq.at_least_one(df, "value", where="value IS NULL")) == [(0,)]


def test_not_null_proportion(frame):
    df = frame("p int, g int", [(1, 1), (None, 1), (3, 2), (4, 2)])
    assert passes(dq.not_null_proportion(df, "p", 0.75, 0.75))
    assert rows_of(dq.not_null_proportion(df, "p", 0.8)) == [(0.75,)]
    assert rows_of(dq.not_null_proportion(df, "p", 0.8, group_by=["g"])) == [(1, 0.5)]


def test_not_empty_string(frame):
    df = frame("s string", [("x",), ("  ",), (None,)])
    assert rows_of(dq.not_empty_string(df, "s")) == [("",)]
    assert passes(dq.not_empty_string(df, "s", trim_whitespace=False))


def test_accepted_range(frame):
    df = frame("id int, low int", [(-1, -5), (11, 3), (None, 0), (5, 7)])
    assert passes(dq.accepted_range(df, "id", -1, 11))
    assert row_set(dq.accepted_range(df, "id", -1, 11, inclusive=False)) == {(-1, -5), (11, 3)}
    assert row_set(dq.accepted_range(df, "id", min_value="low")) == {(5, 7)}
    assert passes(dq.accepted_range(df, "id", 0, where="id <> -1"))
    assert passes(dq.accepted_range(df, "id"))


def test_expression_is_true(frame):
    df = frame("a double, b double", [(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)])
    assert passes(dq.expression_is_true(df, "a + b = 1"))
    assert passes(dq.expression_is_true(df, "= 0.5", "a", where="b = 0.5"))
    assert rows_of(dq.expression_is_true(df, "> 0", "a")) == [(0.0, 1.0)]


def test_recency(frame):
    df = frame("t timestamp, g int", [(datetime(2024, 1, 10, 9), 1), (datetime(2024, 1, 8), 2)])
    now = "2024-01-11 10:00:00"
    assert passes(dq.recency(df, "t", "day", 2, now))
    assert [r[0] for r in rows_of(dq.recency(df, "t", "day", 2, now, group_by=["g"]))] == [2]
    assert not passes(dq.recency(df, "t", "day", 1, now))
    assert passes(dq.recency(df, "t", "day", 1, now, ignore_time=True))


def test_row_counts(frame):
    a = frame("f int, g int", [(1, 1), (2, 1), (3, 2)])
    b = frame("f int, g int", [(1, 1), (2, 2), (3, 2), (4, 3)])
    assert rows_of(dq.equal_rowcount(a, a)) == [(3, 3, 0)]
    assert rows_of(dq.equal_rowcount(a, b)) == [(3, 4, 1)]
    grouped = {(r.g_a, r.g_b): r.diff_count for r in dq.equal_rowcount(a, b, ["g"]).collect()}
    assert grouped == {(1, 1): 1, (2, 2): 1, (None, 3): None}
    assert rows_of(dq.fewer_rows_than(a, b)) == [(3, 4, 0)]
    assert rows_of(dq.fewer_rows_than(a, a)) == [(3, 3, 1)]
    assert rows_of(dq.fewer_rows_than(b, a)) == [(4, 3, 1)]
    assert rows_of(dq.equal_rowcount(a, b.limit(0))) == [(3, None, None)]


def test_equality(frame):
    a = frame("id int, x double, skip int", [(1, 1.00001, 1), (1, 1.00001, 1), (2, None, 2)])
    b = frame("id int, x double, skip int", [(2, None, 2), (1, 1.00002, 9)])
    assert passes(dq.equality(a, a.distinct()))  # as sets
    assert not passes(dq.equality(a, b, exclude_columns=["SKIP"]))
    assert passes(dq.equality(a, b, exclude_columns=["skip"], precision=4))
    assert not passes(dq.equality(a, b, exclude_columns=["skip"], precision=8))
    assert passes(dq.equality(a, b, compare_columns=["id"]))
    with pytest.raises(ValueError):
        dq.equality(a, b, compare_columns=["id"], exclude_columns=["x"])
    with pytest.raises(ValueError):
        dq.equality(a, b.drop("skip"))


def test_cardinality_equality(frame):
    a, b = frame("x int", [(1,), (1,), (2,), (4,)]), frame("y int", [(1,), (1,), (2,), (2,), (3,)])
    assert passes(dq.cardinality_equality(a, "x", a.withColumnRenamed("x", "y"), "y"))
    assert row_set(dq.cardinality_equality(a, "x", b, "y")) == {(2, 1), (2, 2), (3, 1), (4, 1)}


def test_unique_combination(frame):
    df = frame("month string, product string", [("a", "x"), ("a", "y"), ("b", "x")])
    assert passes(dq.unique_combination(df, ["month", "product"]))
    assert rows_of(dq.unique_combination(df, ["month"])) == [("a",)]


def test_sequential_values(frame):
    even = frame("v int, g string", [(2, "a"), (4, "a"), (6, "a"), (8, "b"), (10, "b")])
    assert passes(dq.sequential_values(even, "v", 2))
    assert passes(dq.sequential_values(even, "v", 2, group_by=["g"]))
    assert not passes(dq.sequential_values(even, "v", 1))
    hours = frame("t timestamp", [(datetime(2024, 1, 1, h),) for h in (0, 1, 2, 4)])
    assert rows_of(dq.sequential_values(hours, "t", 1, "hour")) == [
        (datetime(2024, 1, 1, 4), datetime(2024, 1, 1, 2), 1)]


RANGES = {"not_allowed": [(0, 1), (1, 2), (2, 3)], "allowed": [(0, 1), (2, 3), (3, 4)],
          "required": [(0, 1), (2, 3), (4, 5)]}


@pytest.mark.parametrize("rule", RANGES)
@pytest.mark.parametrize("rows", RANGES)
def test_exclusive_ranges(frame, rule, rows):
    df = frame("lower int, upper int", RANGES[rows])
    expected = {"not_allowed": rows == "not_allowed", "allowed": True, "required": rows == "required"}[rule]
    assert passes(dq.mutually_exclusive_ranges(df, "lower", "upper", gaps=rule)) == expected


def test_exclusive_ranges_details(frame):
    zero = frame("lower int, upper int", [(0, 1), (2, 2), (3, 4)])
    assert not passes(dq.mutually_exclusive_ranges(zero, "lower", "upper"))
    assert passes(dq.mutually_exclusive_ranges(zero, "lower", "upper", zero_length_range_allowed=True))
    spans = frame("id int, lower int, upper int", [(1, 0, 5), (2, 3, 9), (1, 4, 6), (1, 4, 6), (2, 9, None)])
    failing = dq.mutually_exclusive_ranges(spans, "lower", "upper", partition_by=["id"])
    assert row_set(failing) == {(1, 0, 5, 4, 1), (1, 4, 6, 4, 1), (2, 9, None, None, 1)}
    with pytest.raises(ValueError):
        dq.mutually_exclusive_ranges(spans, "lower", "upper", gaps="maybe")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "b"]), st.integers(0, 30)), max_size=60))
def test_sequential_values_against_brute_force(frame, rows):
    """Ranges cut groups anywhere; the result must not show it."""
    expected: dict[tuple, int] = {}
    for group in {g for g, _ in rows}:
        values = sorted(v for g, v in rows if g == group)
        for prev, value in zip(values, values[1:]):
            if value != prev + 1:
                expected[group, value, prev] = expected.get((group, value, prev), 0) + 1
    df = frame("g string, v int", rows)
    found = {tuple(r)[:3]: r.n_rows for r in dq.sequential_values(df, "v", group_by=["g"]).collect()}
    assert found == expected


def test_schema_contract(frame):
    df = frame("a int, b string, extra int", [(1, "x", 2)])
    assert passes(dq.schema_contract(df, declared("a int, B string, extra int")))
    assert row_set(dq.schema_contract(df, declared("a bigint, b string, c int"))) == {
        ("a", "bigint", "int"), ("c", "int", None), ("extra", None, "int")}


@pytest.mark.parametrize("now, status", [("2024-01-01 05:00:00", "pass"), ("2024-01-01 07:00:00", "warn"),
                                         ("2024-01-02 00:30:00", "error")])
def test_source_freshness(frame, now, status):
    df = frame("t timestamp", [(datetime(2024, 1, 1),), (datetime(2023, 1, 1),)])
    assert dq.source_freshness(df, "t", now).head().status == status


def test_source_freshness_of_empty_table(frame):
    df = frame("t timestamp", [])
    assert dq.source_freshness(df, "t", "2024-01-01").head().status == "error"


def test_suite(frame):
    df = frame("id int, v int", [(1, 5), (2, None), (2, -1)])
    suite = dq.run_suite([
        dq.Check("v_not_null", df, dq.fails_not_null("v")),
        dq.Check("v_positive", df, dq.fails_range("v", 0), severity="warn"),
        dq.Check("id_positive", df, dq.fails_expression("id > 0")),
        dq.Check("id_unique", failing=lambda: dq.unique(df, "id"), warn_if="> 0", error_if="> 5"),
        dq.Check("must_fail", failing=lambda: dq.unique(df, "id"), error_if="< 1", warn_if="< 1"),
        dq.Check("counts", failing=lambda: dq.equal_rowcount(df, df.limit(1)),
                 failures=F.sum(F.coalesce("diff_count", F.lit(0)))),
        dq.Check("filtered", df, dq.fails_not_null("v"), where="id = 1"),
    ])
    assert row_set(suite) == {
        ("v_not_null", 1, "error", "error"), ("v_positive", 1, "warn", "warn"),
        ("id_positive", 0, "error", "pass"), ("id_unique", 1, "error", "warn"),
        ("must_fail", 1, "error", "pass"), ("counts", 2, "error", "error"),
        ("filtered", 0, "error", "pass")}
    with pytest.raises(ValueError):
        dq.Check("both", df, F.lit(True), failing=lambda: df)
    with pytest.raises(ValueError):
        dq.Check("no_table", row_rule=F.lit(True))
    with pytest.raises(ValueError):
        dq.Check("where_outside", failing=lambda: df, where="id = 1")
