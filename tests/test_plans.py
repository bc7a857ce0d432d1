"""The plans, not the results: what must hold for large inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripflow.operators import dedup, quality, sets
from tripflow.operators.joins import join_dimension_twice
from tripflow.plans import reports
from tripflow.queries import QUERIES
from tripflow.schemas import PAYMENT_TYPE_ROWS, PAYMENT_TYPES
from tripflow.sources.readers import seed

SF_DIR = "/root/testdata/sf0.001"

def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = physical(dedup.keep_first(df, ["k"], ["id"]))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "row_number(), 1, Final" in above and "row_number(), 1, Partial" in below


def test_min_by_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = physical(dedup.keep_min_by(df, ["k"], "id"))
    assert "row_number(), 1, Partial" in plan.split("Exchange hashpartitioning", 1)[1]
    assert "SortAggregate" not in plan


def test_monthly_mart_joins_the_pickup_zone_only(spark):
    """Two feeds of three tables with one lookup each, and the zones: nothing the mart does not use."""
    plan = physical(QUERIES["monthly_zone_revenue"](spark, SF_DIR))
    assert plan.count("FileScan") <= 10 and "payment_type_description" not in plan


def test_counts_side_by_side_are_one_shuffle(spark):
    a = spark.range(10).toDF("x")
    plan = physical(quality.equal_rowcount(a, a, ["x"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_reports_aggregate_before_the_shuffle(spark):
    for key in ["hourly_revenue", "monthly_revenue_decimal", "daily_stats", "monthly_zone_revenue"]:
        plan = physical(QUERIES[key](spark, SF_DIR))
        assert "partial_sum" in plan.split("Exchange hashpartitioning", 1)[1]


def test_set_difference_is_one_shuffle(spark):
    a = spark.range(10).toDF("x")
    assert physical(sets.one_sided_rows(a, a)).count("Exchange hashpartitioning") == 1


def test_row_rules_of_a_suite_share_one_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = [quality.Check(f"c{i}", df, quality.fails_expression(f"id <> {i}")) for i in range(5)]
    assert physical(quality.run_suite(checks)).count("FileScan") == 1


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, tmp_path):
    facts = spark.range(1000).select("id", (F.col("id") % 5).alias("pu"), (F.col("id") % 7).alias("do"))
    dim = spark.range(10).select(F.col("id").alias("location_id"), F.lit("z").alias("zone"))

    def joined():
        return physical(join_dimension_twice(facts, dim, "location_id", "pu", "do", {"zone": "zone"},
                                             ("pickup_", "dropoff_")))

    assert joined().count("BroadcastHashJoin") == 2
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16b")
    try:
        assert "BroadcastHashJoin" not in joined() and joined().count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_seed_is_known_to_be_small(spark):
    rows = spark.range(1000).select((F.col("id") % 7).cast("int").alias("code"))
    joined = rows.join(seed(spark, PAYMENT_TYPE_ROWS, PAYMENT_TYPES), F.col("code") == F.col("payment_type"))
    assert "BroadcastHashJoin" in physical(joined)


def test_scan_reads_needed_columns_and_pushes_filters(spark):
    plan = physical(QUERIES["distinct_in_range"](spark, SF_DIR))
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp>" in plan
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<>" in physical(QUERIES["count_all"](spark, SF_DIR))


def test_staging_rules_reach_the_scan(spark, tmp_path):
    """Bounds on plain columns are pushed, and nothing is converted to be tested."""
    from tripflow.plans import staging
    path = str(tmp_path / "feed")
    (spark.createDataFrame([], staging.GREEN.schema)
     .withColumns({"unique_row_id": F.lit("id"), "filename": F.lit("f")}).write.parquet(path))
    plan = physical(staging.stage_feed(spark.read.parquet(path), staging.GREEN))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    for pushed in ("GreaterThanOrEqual(fare_amount", "LessThan(trip_distance,50.0", "GreaterThanOrEqual(total_amount",
                   "LessThanOrEqual(passenger_count,6)", "IsNotNull(VendorID)"):
        assert pushed in scan, pushed
    rules = next(line for line in plan.splitlines() if "Filter" in line)
    assert "decimal" not in rules and "raise_error" not in plan


def test_outer_join_reuses_the_aggregates_partitioning(spark):
    schema = "at timestamp, zone int, amount double"
    feeds = [spark.createDataFrame([], schema) for _ in range(2)]
    one, two = (reports.hourly_revenue(f, "at", "zone", "amount", "2020-01-01 00:00:00") for f in feeds)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(reports.hourly_revenue_both(one, two))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "FullOuter" in plan and plan.count("Exchange hashpartitioning") == 2


def test_hot_key_join_is_split(spark):
    """A third of the rows under one key: adaptive execution splits its partition."""
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    other = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = hot.join(other, "k", "left")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in physical(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
