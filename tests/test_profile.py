"""Mergeable sketches: distinct counts of ranges, and the profile of all columns."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set
from tests.test_plans import physical
from tripflow.operators import profile, sketches


@pytest.fixture(scope="module")
def visits(spark):
    """Users that come back, over sixty days; one day holds a third of the rows."""
    rnd = random.Random(2)
    rows = [(datetime(2024, 1, 1) + timedelta(days=0 if rnd.random() < 0.33 else rnd.randrange(60)),
             rnd.randrange(8000), rnd.choice("abcde"), None if rnd.random() < 0.1 else rnd.random()) for _ in range(30_000)]
    return spark.createDataFrame(rows, "ts timestamp, user long, c string, x double").repartition(6)


@pytest.mark.parametrize("days", [1, 7, 31, 60])
def test_ranges_are_within_the_bound(spark, visits, days, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.day_sketches(visits, "ts", ["user", "c", "x"]).write.parquet(path)
    stored, end = spark.read.parquet(path), date(2024, 1, 1) + timedelta(days=days - 1)
    found = sketches.distinct_between(stored, ["user", "c", "x"], "2024-01-01", str(end)).head()
    exact = visits.where(F.to_date("ts") <= F.lit(end)).agg(
        F.count("*").alias("n"), *[F.count_distinct(c).alias(c) for c in ("user", "c", "x")]).head()
    assert found.n_rows == exact.n and found.c == exact.c
    for name in ("user", "x"):
        assert abs(found[name] - exact[name]) <= sketches.error_bound() * exact[name]


def test_a_reloaded_day_replaces_its_sketch_only(spark, frame):
    schema = "ts timestamp, v string, k int"
    day = lambda d, values: [(datetime(2024, 1, d), v, 1) for v in values]
    first = sketches.day_sketches(frame(schema, day(1, "aab") + day(2, ["c", None])), "ts", ["v"], ["k"])
    again = sketches.day_sketches(frame(schema, day(2, "abcd")), "ts", ["v"], ["k"])
    merged = first.where(F.col("day") != F.lit(date(2024, 1, 2))).unionByName(again)
    counts = lambda s: tuple(sketches.merged_counts(s, ["v"]).head())
    assert counts(first) == (5, 3) and counts(merged) == (7, 4)
    assert row_set(sketches.merged_counts(first, ["v"], ["day"])) == {(date(2024, 1, 1), 3, 2), (date(2024, 1, 2), 2, 1)}
    assert sketches.merged_counts(first.limit(0), ["v"], ["day"]).collect() == []


def test_a_hot_day_is_sketched_before_the_shuffle(visits):
    plan = physical(sketches.day_sketches(visits, "ts", ["user"]))
    assert "partial_hll_sketch_agg" in plan.split("Exchange hashpartitioning(_groupingexpression", 1)[1]


ROWS = [(1, 1.5, "a", D("1.10"), date(2024, 1, 1), True, [1], b"x"), (2, None, " ", None, None, None, None, None),
        (None, float("nan"), "", D("2.20"), date(2024, 3, 1), False, [1, 2], b"y"), (2, float("inf"), "a", None, None, True, [], b"x"),
        (5, -3.0, None, D("-1.00"), date(2024, 2, 1), True, [1], b"z")]
SCHEMA = "`a.b` int, x double, s string, d decimal(10,2), day date, flag boolean, list array<int>, bytes binary"


def as_dict(df):
    return {r["column"]: r for r in df.collect()}


def test_all_columns_of_all_types(frame):
    found = as_dict(profile.profile_table(frame(SCHEMA, ROWS)))
    assert list(found) == ["a.b", "x", "s", "d", "day", "flag", "list", "bytes"]
    assert all(r.n_rows == 5 for r in found.values())
    assert {c: r.n_null for c, r in found.items()} == {"a.b": 1, "x": 1, "s": 1, "d": 2, "day": 2, "flag": 1, "list": 1, "bytes": 1}
    assert {c: r.n_distinct for c, r in found.items()} == {"a.b": 3, "x": 4, "s": 3, "d": 3, "day": 3, "flag": 2, "list": 3, "bytes": 3}
    assert (found["a.b"].least, found["a.b"].most, found["a.b"].mean, found["a.b"].quantiles) == ("1", "5", 2.5, [1.0, 2.0, 2.0])
    assert (found["d"].least, found["d"].most, round(found["d"].mean, 9)) == ("-1.00", "2.20", 0.766666667)
    assert (found["day"].least, found["day"].most, found["day"].mean, found["day"].quantiles) == ("2024-01-01", "2024-03-01", None, None)
    # numbers that are none count as values, but have no place among means and ranks
    assert (found["x"].mean, found["x"].quantiles) == (-0.75, [-3.0, -3.0, 1.5])
    assert found["s"].n_blank == 2 and found["a.b"].n_blank is None
    assert found["s"].top_values[0].asDict() == {"item": "a", "count": 2}
    assert found["flag"].top_values[0].asDict() == {"item": "true", "count": 3}
    assert found["list"].least is None and found["list"].type == "array<int>"


def test_merged_parts_are_the_whole(spark, visits, tmp_path):
    path = str(tmp_path / "parts")
    profile.column_sketches(visits, [F.to_date("ts").alias("day")]).write.parquet(path)
    parts = spark.read.parquet(path)
    assert parts.count() == 60
    merged, whole = as_dict(profile.profile(parts)), as_dict(profile.profile_table(visits))
    for name, row in whole.items():
        for part in ("n_rows", "n_null", "n_blank", "least", "most"):
            assert merged[name][part] == row[part]
    assert abs(merged["user"].n_distinct - 8000) < 0.049 * 8000
    exact = dict(visits.groupBy("c").count().collect())
    assert {t["item"]: t["count"] for t in merged["c"].top_values} == exact
    values = sorted(r.x for r in visits.where("x is not null").select("x").collect())
    for wanted, value in zip((0.25, 0.5, 0.75), merged["x"].quantiles):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - wanted) < 0.017


def test_one_scan_whatever_the_columns(spark, tmp_path):
    spark.range(100).selectExpr("id a", "id * 2 b", "string(id) c").write.parquet(str(tmp_path / "t"))
    df = profile.profile_table(spark.read.parquet(str(tmp_path / "t")))
    assert physical(df).count("FileScan") == 1
    assert {r.n_rows for r in df.collect()} == {100}
    some = profile.profile_table(spark.read.parquet(str(tmp_path / "t")), ["b"])
    assert "ReadSchema: struct<b:bigint>" in physical(some) and [r["column"] for r in some.collect()] == ["b"]


def test_nothing_to_profile(spark, frame):
    empty = as_dict(profile.profile_table(frame(SCHEMA, [])))
    assert {(r.n_rows, r.n_null, r.n_distinct, r.least, r.mean, r.quantiles) for r in empty.values()} == {
        (0, 0, 0, None, None, None)}
    nulls = as_dict(profile.profile_table(frame("x double, s string", [(None, None)] * 3)))
    assert {(r.n_null, r.n_distinct, tuple(r.top_values)) for r in nulls.values()} == {(3, 0, ())}
    with pytest.raises(ValueError):
        profile.column_sketches(frame("x int", []), columns=["y"])


def test_two_profiles_side_by_side(frame):
    before = profile.profile_table(frame("a int, b string", [(1, "x"), (None, "y")]))
    after = profile.profile_table(frame("a int, c string", [(1, "x"), (2, "y"), (3, None), (None, None)]))
    found = {r["column"]: tuple(r)[1:] for r in profile.profile_changes(before, after).collect()}
    assert found == {"a": ("int", "int", 0.5, 0.25, 1, 3), "b": ("string", None, 0.0, None, 2, None),
                     "c": (None, "string", None, 0.5, None, 2)}
