from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set, rows_of
from tripflow.operators import aggregates as agg
from tripflow.operators import columns, dedup, generators, joins, sets
from tripflow.sources.catalog import relations_by_pattern, relations_by_prefix


def test_keep_first(frame):
    df = frame("user_id int, event string, version int", [(1, "play", 1), (1, "play", 2), (2, "pause", 1)])
    one = df.where("user_id = 1")
    assert rows_of(dedup.keep_first(one, ["user_id"], [F.desc("version")])) == [(1, "play", 2)]


@pytest.mark.parametrize("keep", [dedup.keep_first, lambda d, k, o: dedup.keep_min_by(d, k, o[0])])
def test_keep_first_keeps_rows_with_nulls(frame, keep):
    df = frame("k int, o int, v string", [(1, 2, None), (1, None, "x"), (None, 1, None), (2, None, None)])
    # NULL sorts first
    assert row_set(keep(df, ["k"], ["o"])) == {(1, None, "x"), (None, 1, None), (2, None, None)}


def test_pivot(frame):
    df = frame("size string, color string", [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")])
    result = df.groupBy("size").agg(*agg.pivot("color", ["red", "blue", "blue's"]))
    assert result.columns == ["size", "red", "blue", "blue's"]
    assert row_set(result) == {("S", 1, 1, 1), ("M", 1, 0, 0)}


def test_pivot_options(frame):
    df = frame("size string, n int", [("S", 1), ("S", 5), ("S", 5), ("M", 7)])
    result = df.groupBy("size").agg(*agg.pivot("n", [5], agg="count", cmp=">=", prefix="N ", suffix="-up",
                                               then_value=F.col("n"), else_value=F.lit(None),
                                               quote_identifiers=False, distinct=True))
    assert result.columns == ["size", "n_5_up"]
    assert row_set(result) == {("S", 1), ("M", 1)}
    with pytest.raises(KeyError):
        agg.pivot("n", [1], cmp="~")


UNPIVOT = [(7, datetime(2020, 5, 4), "open", "gold", "Ada"),
           (8, datetime(2021, 6, 5), "shut", "iron", "Bo"),
           (9, datetime(2022, 7, 6), "open", "iron", "Cy")]


def test_unpivot(frame):
    df = frame("customer_id int, created_at timestamp, status string, segment string, name string", UNPIVOT)
    result = columns.unpivot(df, exclude=["customer_id", "created_at"], remove=["name"], field_name="prop",
                             value_name="val")
    assert result.columns == ["customer_id", "created_at", "prop", "val"]
    assert result.count() == 6
    assert (7, datetime(2020, 5, 4), "status", "open") in row_set(result)


def test_unpivot_booleans_and_mixed_case(frame):
    df = frame("Customer_Id int, sTaTuS string, is_updated boolean",
               [(1, "a", True), (2, "b", False), (3, "c", None)])
    result = columns.unpivot(df, exclude=["customer_id"])
    assert result.columns[0] == "Customer_Id"
    assert {r for r in row_set(result) if r[1] == "is_updated"} == {
        (1, "is_updated", "true"), (2, "is_updated", "false"), (3, "is_updated", None)}
    assert (1, "sTaTuS", "a") in row_set(result)
    with pytest.raises(ValueError):
        columns.unpivot(df, exclude=df.columns)


def test_star(frame):
    df = frame("field_1 string, field_2 string, field_3 string", [("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")])
    assert row_set(df.select(*columns.star(df, exclude=["FIELD_3"]))) == {("a", "b"), ("d", "e"), ("g", "h")}
    assert df.select(*columns.star(df, prefix="p_", suffix="_s")).columns[0] == "p_field_1_s"
    joined = df.alias("x").join(df.alias("y"), F.col("x.field_1") == F.col("y.field_1"))
    assert joined.select(*columns.star(df, relation_alias="y")).columns == df.columns
    with pytest.raises(ValueError):
        columns.star(df, exclude=df.columns)


def test_nullcheck(frame):
    df = frame("a string, b int", [("", 1), ("x", None)])
    assert row_set(columns.nullcheck_table(df)) == {(None, 1), ("x", None)}


@pytest.fixture
def tables(frame):
    return {
        "t1": frame("id int, name string, favorite_number string",
                    [(11, "ada", "x"), (12, "bo", "y"), (13, "cy", "5")]),
        "t2": frame("id int, favorite_color string, favorite_number int", [(11, "teal", 3), (12, "plum", 8)]),
    }


def test_union_relations(tables):
    result = sets.union_relations(tables, source_column_name="src")
    assert result.columns == ["src", "id", "name", "favorite_number", "favorite_color"]
    assert dict(result.dtypes)["favorite_number"] == "string"
    assert row_set(result) == {
        ("t1", 11, "ada", "x", None), ("t1", 12, "bo", "y", None), ("t1", 13, "cy", "5", None),
        ("t2", 11, None, "3", "teal"), ("t2", 12, None, "8", "plum")}


def test_union_options(tables):
    assert sets.union_relations(tables, where="id = 11").count() == 2
    assert sets.union_relations(tables, include=["ID"], source_column_name=None).columns == ["id"]
    excluded = sets.union_relations(tables, exclude=["Name", "favorite_color"], source_column_name=None,
                                    column_override={"id": "bigint"})
    assert excluded.dtypes == [("id", "bigint"), ("favorite_number", "string")]
    with pytest.raises(ValueError):
        sets.union_relations(tables, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        sets.union_relations(tables, include=["nothing"])
    # the first relation decides the type; a value that does not fit is an error unless asked otherwise
    swapped = {"t2": tables["t2"], "t1": tables["t1"]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sets.union_relations(swapped).collect()
    assert (11, None) in row_set(sets.union_relations(swapped, include=["id", "favorite_number"],
                                                     source_column_name=None, try_casts=True))


def test_one_sided_rows(frame):
    a = frame("x int, y string", [(1, None), (1, None), (2, "b"), (3, "c")])
    b = frame("x int, y string", [(1, None), (2, "b"), (2, "z")])
    assert row_set(sets.one_sided_rows(a, b)) == {("a_minus_b", 3, "c"), ("b_minus_a", 2, "z")}


def test_generate_series(spark):
    assert rows_of(generators.generate_series(spark, 10)) == [(i,) for i in range(1, 11)]
    with pytest.raises(ValueError):
        generators.generate_series(spark, 0)


def test_date_spine(spark, frame):
    spine = generators.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    days = sorted(r[0] for r in rows_of(spine))
    assert spine.columns == ["date_day"] and len(days) == 9 and days[-1] == datetime(2018, 1, 9)
    assert generators.date_spine(spark, "month", "2018-01-31", "2018-04-01").count() == 3
    with pytest.raises(ValueError):
        generators.date_spine(spark, "day", "2018-01-01", "2018-01-01")
    bounds = frame("k int, start timestamp, end timestamp", [
        (1, datetime(2018, 1, 1), datetime(2018, 1, 3)), (2, datetime(2018, 1, 1), datetime(2018, 1, 1))])
    assert row_set(generators.date_spine_over(bounds, "day")) == {
        (1, datetime(2018, 1, 1)), (1, datetime(2018, 1, 2))}


def test_group_by_first(frame):
    df = frame("a int, b int, c int", [(1, 2, 3)])
    assert rows_of(agg.group_by_first(df, 2).agg(F.count("*"))) == [(1, 2, 1)]
    with pytest.raises(ValueError):
        agg.group_by_first(df, 4)


def test_values_and_bounded_lists(frame):
    df = frame("c string, v int", [("a", 1), ("b", 1), ("b", 2), ("c", 3)])
    assert [r[0] for r in rows_of(agg.column_values(df, "c"))] == ["b", "a", "c"]
    assert agg.column_value_list(df, "c", max_records=9, where="v < 3") == ["b", "a"]
    assert agg.column_value_list(df, "c", max_records=9, where="v > 9", default=["none"]) == ["none"]
    with pytest.raises(ValueError):
        agg.column_value_list(df, "c", max_records=2)
    assert agg.single_value(df.where("v > 9"), default=0) == 0
    assert agg.single_value(df.agg(F.max("v"))) == 3
    assert agg.results_as_dict(df.orderBy("v", "c").limit(2), max_rows=9) == {"c": ["a", "b"], "v": [1, 1]}
    with pytest.raises(ValueError):
        agg.results_as_dict(df, max_rows=2)


def test_column_profile(frame):
    df = frame("v int, m double", [(1, 2.0), (1, 4.0), (9, 1.0), (9, 1.0)])
    bucket = F.when(F.col("v") < 5, "low").otherwise("high")
    assert row_set(agg.column_profile(df, bucket, F.col("m"))) == {("low", 2, 3.0, 0.5), ("high", 2, 1.0, 0.5)}


def test_joins(frame):
    facts = frame("id int, pu int, do int, pay int", [(1, 10, 20, 1), (2, 99, None, None), (3, 20, 10, 77)])
    dim = frame("location_id int, zone string", [(10, "A"), (20, "B")])
    both = joins.join_dimension_twice(facts, dim, "location_id", "pu", "do", {"zone": "zone"}, ("p_", "d_"))
    assert {(r.id, r.p_zone, r.d_zone) for r in both.collect()} == {(1, "A", "B"), (2, None, None), (3, "B", "A")}
    lookup = frame("pay int, description string", [(0, "Unknown"), (1, "Card")])
    named = joins.lookup_with_default(facts, lookup, "pay", 0, "description", "Other", "text")
    assert {(r.id, r.pay, r.text) for r in named.collect()} == {(1, 1, "Card"), (2, 0, "Unknown"), (3, 77, "Other")}
    assert {r.id for r in joins.orphans(facts, dim, "do", "location_id").collect()} == set()
    assert {r.id for r in joins.orphans(facts, dim, "pu", "location_id").collect()} == {2}


def test_relations_by_name(spark, frame):
    for name in ["zz_data_a", "zz_data_b", "zz_other"]:
        frame("x int", [(1,)]).createOrReplaceTempView(name)
    assert list(relations_by_prefix(spark, "ZZ_data_")) == ["zz_data_a", "zz_data_b"]
    assert list(relations_by_pattern(spark, "zz%", exclude="%_a")) == ["zz_data_b", "zz_other"]
    assert sets.union_relations(relations_by_prefix(spark, "zz_data_")).count() == 2
