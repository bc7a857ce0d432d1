"""Tables clustered by key: what a join and a keep-first step need not shuffle, and hot keys."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set
from tests.test_plans import physical
from tripflow.operators.dedup import keep_first
from tripflow.sources import clustered


@pytest.fixture
def make(spark, tmp_path):
    def write(df, keys, buckets=4, **options):
        name = f"t_{uuid.uuid4().hex}"
        clustered.write_clustered(df, name, keys, buckets, str(tmp_path / name), **options)
        return name
    return write


def rows(spark, n, hot=False):
    key = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")) if hot else F.col("id") % 50
    return spark.range(n).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text"))


def without_broadcasts(spark, build):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return physical(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_joins_and_groups_on_the_key_need_no_shuffle(spark, make):
    one, two = (clustered.read_clustered(spark, make(rows(spark, 400), ["k"])) for _ in range(2))
    joined = lambda: one.join(two.withColumnRenamed("id", "other"), "k").groupBy("k").count()
    plan = without_broadcasts(spark, joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert row_set(joined()) == {(k, 64) for k in range(50)}
    first = keep_first(one, ["k"], ["id"])
    assert "Exchange" not in physical(first)
    assert row_set(first.select("k", "id")) == {(k, k) for k in range(50)}
    plain = without_broadcasts(spark, lambda: rows(spark, 400).join(rows(spark, 400).withColumnRenamed("id", "o"), "k"))
    assert plan.count("Exchange") < plain.count("Exchange")


def test_one_sorted_file_per_bucket(spark, make, tmp_path):
    name = make(rows(spark, 400), ["k"])
    sizes = clustered.bucket_bytes(spark, str(tmp_path / name))
    assert set(sizes) == {0, 1, 2, 3}
    assert len(list((tmp_path / name).glob("part-*.parquet"))) == 4
    for file in (tmp_path / name).glob("part-*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).select("k").collect()]
        assert keys == sorted(keys)


def test_a_heavy_bucket_is_read_as_plain_files(spark, make, tmp_path):
    name = make(rows(spark, 6000, hot=True), ["k"], 16)
    sizes = clustered.bucket_bytes(spark, str(tmp_path / name))
    assert max(sizes.values()) > 4 * sum(sizes.values()) / 16
    even = clustered.read_clustered(spark, name)  # small tables are not worth it
    split = clustered.read_clustered(spark, name, least_bytes=1000)
    assert "Exchange" not in physical(even.groupBy("k").count())
    assert "Exchange" in physical(split.groupBy("k").count())
    assert even.schema == split.schema and row_set(even) == row_set(split) == row_set(rows(spark, 6000, hot=True))


def test_hot_keys_may_have_several_files(spark, make, tmp_path):
    name = make(rows(spark, 2000, hot=True), ["k"], 4, files_per_bucket=3)
    assert len(list((tmp_path / name).glob("part-*.parquet"))) > 4
    table = clustered.read_clustered(spark, name)
    assert "Exchange" not in physical(table.groupBy("k").count())
    assert row_set(table) == row_set(rows(spark, 2000, hot=True))


def test_an_empty_table(spark, make):
    assert clustered.read_clustered(spark, make(rows(spark, 0), ["k", "id"])).collect() == []
