"""Data-quality checks. Each query returns the failing rows, so rules are chosen that some rows break."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as dq
from ..plans import marts
from ..schemas import declared
from . import _tables as t
from ._registry import query


@query("dq_unique", """SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    return dq.unique(t.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("dq_not_null", f"""WITH {t.TRIPS_SQL}
SELECT vendor_id, pickup_datetime, service_type FROM trips WHERE vendor_id IS NULL""")
def dq_not_null(spark, sf_dir):
    return dq.not_null(t.trips(spark, sf_dir), "vendor_id").select(
        "vendor_id", "pickup_datetime", "service_type")


@query("dq_accepted_values", """SELECT o_orderstatus AS value_field, count(*) AS n_records FROM orders
WHERE o_orderpriority <> '5-LOW' GROUP BY 1 HAVING o_orderstatus NOT IN ('O', 'F')""")
def dq_accepted_values(spark, sf_dir):
    return dq.accepted_values(t.table(spark, sf_dir, "orders"), "o_orderstatus", ["O", "F"],
                              where="o_orderpriority <> '5-LOW'")


@query("dq_relationships", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}
SELECT pickup_location_id AS id FROM trips
WHERE pickup_location_id NOT IN (SELECT locationid FROM zones)""")
def dq_relationships(spark, sf_dir):
    return dq.relationships(t.trips(spark, sf_dir), "pickup_location_id", t.zones(spark, sf_dir),
                            "locationid")


@query("dq_relationships_where", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}
SELECT pickup_location_id AS id FROM trips WHERE pickup_location_id <> 0
AND pickup_location_id NOT IN (SELECT locationid FROM zones WHERE service_zone = 'Boro Zone')""")
def dq_relationships_where(spark, sf_dir):
    return dq.relationships(t.trips(spark, sf_dir), "pickup_location_id", t.zones(spark, sf_dir),
                            "locationid", from_condition="pickup_location_id <> 0",
                            to_condition="service_zone = 'Boro Zone'")


def _rowcount_sql(columns: str) -> str:
    return f"""SELECT a.k AS l_returnflag_a, b.k AS l_returnflag_b, {columns}
FROM (SELECT l_returnflag AS k, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) a
FULL JOIN (SELECT l_returnflag AS k, count(*) AS n FROM lineitem
           WHERE l_linestatus = 'F' AND l_returnflag <> 'A' GROUP BY 1) b ON a.k = b.k"""


def _open_and_filled(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    return (lines.where("l_linestatus = 'O'"),
            lines.where("l_linestatus = 'F' AND l_returnflag <> 'A'"))


@query("dq_equal_rowcount", _rowcount_sql("a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count"))
def dq_equal_rowcount(spark, sf_dir):
    return dq.equal_rowcount(*_open_and_filled(spark, sf_dir), group_by=["l_returnflag"])


@query("dq_fewer_rows", _rowcount_sql("""a.n AS count_our_model, b.n AS count_comparison_model,
    CAST(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS BIGINT)
    AS row_count_delta"""))
def dq_fewer_rows(spark, sf_dir):
    return dq.fewer_rows_than(*_open_and_filled(spark, sf_dir), group_by=["l_returnflag"])


def _sides_sql(columns: str) -> str:
    ours = f"SELECT {columns} FROM lineitem WHERE l_linestatus = 'O'"
    theirs = f"SELECT {columns} FROM lineitem WHERE l_linestatus = 'F'"
    return f"""SELECT 'a_minus_b' AS which_diff, * FROM ({ours} EXCEPT {theirs}) UNION ALL
SELECT 'b_minus_a', * FROM ({theirs} EXCEPT {ours})"""


def _open_and_closed(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'")


@query("dq_equality", _sides_sql("l_orderkey, l_linenumber"))
def dq_equality(spark, sf_dir):
    return dq.equality(*_open_and_closed(spark, sf_dir), compare_columns=["L_ORDERKEY", "l_linenumber"])


@query("dq_equality_precision", _sides_sql(
    "l_suppkey, CAST(round(CAST(l_extendedprice / 1000 AS DECIMAL(38,9)), 1) AS DECIMAL(31,1)) AS price"))
def dq_equality_precision(spark, sf_dir):
    ours, theirs = [rows.select("l_suppkey", (F.col("l_extendedprice") / 1000).alias("price"), "l_tax")
                    for rows in _open_and_closed(spark, sf_dir)]
    return dq.equality(ours, theirs, exclude_columns=["l_tax"], precision=1)


@query("dq_not_constant", """SELECT l_orderkey, count(DISTINCT l_suppkey) AS filler_column FROM lineitem
GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1""")
def dq_not_constant(spark, sf_dir):
    return dq.not_constant(t.table(spark, sf_dir, "lineitem"), "l_suppkey", group_by=["l_orderkey"])


# blanks of every kind in place of the urgent orders' status
_BLANKS = """(SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '  ' WHEN '2-HIGH' THEN ''
    ELSE o_orderstatus END AS status FROM orders)"""


def _blanks(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(priority == "1-URGENT", "  ").when(priority == "2-HIGH", "")
        .otherwise(F.col("o_orderstatus")).alias("status"))


@query("dq_not_empty_string", f"SELECT trim(status) AS status FROM {_BLANKS} WHERE trim(status) = ''")
def dq_not_empty_string(spark, sf_dir):
    return dq.not_empty_string(_blanks(spark, sf_dir), "status")


_SPARSE = """(SELECT o_custkey, o_orderpriority,
    CASE WHEN o_totalprice > 250000 THEN o_orderstatus END AS status FROM orders)"""


def _sparse(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority",
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderstatus")).alias("status"))


@query("dq_at_least_one", f"""SELECT o_custkey, count(status) AS filler_column FROM {_SPARSE}
GROUP BY o_custkey HAVING count(status) = 0""")
def dq_at_least_one(spark, sf_dir):
    return dq.at_least_one(_sparse(spark, sf_dir), "status", group_by=["o_custkey"])


@query("dq_not_null_proportion", f"""SELECT o_custkey, count(status) / count(*) AS not_null_proportion
FROM {_SPARSE} GROUP BY o_custkey
HAVING count(status) / count(*) < 0.4 OR count(status) / count(*) > 0.8""")
def dq_not_null_proportion(spark, sf_dir):
    return dq.not_null_proportion(_sparse(spark, sf_dir), "status", 0.4, 0.8, group_by=["o_custkey"])


@query("dq_recency", """SELECT user_id, CAST(max(ts) AS TIMESTAMP) AS most_recent,
    TIMESTAMP '2024-01-30 00:00:00' AS threshold FROM events
GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 00:00:00'""")
def dq_recency(spark, sf_dir):
    return dq.recency(t.event_rows(spark, sf_dir), "ts", "day", 1, "2024-01-31 00:00:00",
                      group_by=["user_id"])


@query("dq_sequential", """SELECT user_id, day, previous_day, count(*) AS n_rows
FROM (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day
      FROM (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day FROM events))
WHERE NOT (day = previous_day + INTERVAL 1 DAY) GROUP BY ALL""")
def dq_sequential(spark, sf_dir):
    days = t.event_rows(spark, sf_dir).select("user_id", F.date_trunc("day", "ts").alias("day"))
    return dq.sequential_values(days, "day", 1, "day", group_by=["user_id"])


@query("dq_sequential_all", """SELECT l_partkey, previous_l_partkey, count(*) AS n_rows
FROM (SELECT l_partkey, lag(l_partkey) OVER (ORDER BY l_partkey) AS previous_l_partkey FROM lineitem)
WHERE NOT (l_partkey = previous_l_partkey + 1) GROUP BY ALL""")
def dq_sequential_all(spark, sf_dir):
    return dq.sequential_values(t.table(spark, sf_dir, "lineitem"), "l_partkey")


@query("dq_unique_combination", """SELECT l_orderkey, l_linenumber FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_combination(spark, sf_dir):
    return dq.unique_combination(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _ranges_sql(rows: str, group: str, rule: str) -> str:
    part = f"PARTITION BY {group}" if group else ""
    select = f"{group}, " if group else ""
    return f"""SELECT {select}low, high, next_lower, count(*) AS n_rows FROM (
    SELECT *, lead(low) OVER w AS next_lower, lead(1) OVER w IS NULL AS is_last FROM {rows}
    WINDOW w AS ({part} ORDER BY low, high))
WHERE NOT (coalesce(low < high, false) AND coalesce({rule}, is_last, false)) GROUP BY ALL"""


@query("dq_exclusive_ranges", _ranges_sql(
    "(SELECT o_custkey, o_orderdate AS low, o_orderdate + INTERVAL 60 DAY AS high FROM orders)",
    "o_custkey", "high <= next_lower"))
def dq_exclusive_ranges(spark, sf_dir):
    stays = t.table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("low"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("high"))
    return dq.mutually_exclusive_ranges(stays, "low", "high", partition_by=["o_custkey"])


@query("dq_exclusive_ranges_all", _ranges_sql(
    "(SELECT ts AS low, ts + INTERVAL 1 MINUTE AS high FROM events)", "", "high < next_lower"))
def dq_exclusive_ranges_all(spark, sf_dir):
    spans = t.event_rows(spark, sf_dir).select(
        F.col("ts").alias("low"), (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("high"))
    return dq.mutually_exclusive_ranges(spans, "low", "high", gaps="required")


@query("dq_accepted_range", f"""WITH {t.TRIPS_SQL}
SELECT pickup_datetime, trip_distance, fare_amount, total_amount FROM trips
WHERE NOT (trip_distance >= 5) OR NOT (trip_distance <= total_amount)""")
def dq_accepted_range(spark, sf_dir):
    return dq.accepted_range(t.trips(spark, sf_dir, exact=True), "trip_distance", 5, "total_amount").select(
        "pickup_datetime", "trip_distance", "fare_amount", "total_amount")


@query("dq_expression", f"""WITH {t.TRIPS_SQL}
SELECT pickup_datetime, dropoff_datetime, vendor_id FROM trips
WHERE vendor_id IS NOT NULL AND NOT (dropoff_datetime > pickup_datetime)""")
def dq_expression(spark, sf_dir):
    return dq.expression_is_true(t.trips(spark, sf_dir), "> pickup_datetime", "dropoff_datetime",
                                 where="vendor_id IS NOT NULL").select(
        "pickup_datetime", "dropoff_datetime", "vendor_id")


@query("dq_not_accepted", """SELECT DISTINCT c_mktsegment AS value_field FROM customer
WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE', 'NONE')""")
def dq_not_accepted(spark, sf_dir):
    return dq.not_accepted_values(t.table(spark, sf_dir, "customer"), "c_mktsegment",
                                  ["MACHINERY", "FURNITURE", "NONE"])


@query("dq_cardinality", """WITH a AS (SELECT l_partkey AS value_field, count(*) AS num_rows FROM lineitem
               WHERE l_linestatus = 'O' GROUP BY 1),
b AS (SELECT l_partkey AS value_field, count(*) AS num_rows FROM lineitem
      WHERE l_linestatus = 'F' GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def dq_cardinality(spark, sf_dir):
    ours, theirs = _open_and_closed(spark, sf_dir)
    return dq.cardinality_equality(ours, "l_partkey", theirs, "l_partkey")


@query("source_freshness", """SELECT CAST(newest AS TIMESTAMP) AS max_loaded_at, round(age, 4) AS age_hours,
    CASE WHEN age > 24 THEN 'error' WHEN age > 6 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS newest, (epoch(TIMESTAMP '2024-01-31 09:00:00')
      - floor(epoch(max(ts)))) / 3600.0 AS age FROM events)""")
def source_freshness(spark, sf_dir):
    fresh = dq.source_freshness(t.event_rows(spark, sf_dir), "ts", "2024-01-31 09:00:00")
    return fresh.withColumn("age_hours", F.round("age_hours", 4))


@query("schema_contract", """
WITH declared(column_name, declared_type) AS (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'int'),
    ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'),
    ('o_comment', 'string')),
actual AS (SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END
    AS actual_type FROM (DESCRIBE orders))
SELECT column_name, declared_type, actual_type FROM declared FULL JOIN actual USING (column_name)
WHERE declared_type IS DISTINCT FROM actual_type""")
def schema_contract(spark, sf_dir):
    """The stored file's own schema against a contract that it breaks in three places."""
    contract = T.StructType([*declared("o_orderkey bigint, o_custkey int, o_orderstatus string, "
                                       "o_totalprice double, o_comment string").fields,
                             T.StructField("o_orderdate", T.TimestampNTZType())])
    return dq.schema_contract(spark.read.parquet(f"{sf_dir}/orders.parquet"), contract)


@query("dq_suite", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}, counted AS (
SELECT 'vendor_not_null' AS name, (SELECT count(*) FROM trips WHERE vendor_id IS NULL) AS failures,
       'error' AS severity UNION ALL
SELECT 'fare_positive', (SELECT count(*) FROM trips WHERE NOT (fare_amount > 0)), 'error' UNION ALL
SELECT 'distance_range', (SELECT count(*) FROM trips WHERE service_type = 'Green'
        AND (NOT (trip_distance >= 0) OR NOT (trip_distance <= 100))), 'warn' UNION ALL
SELECT 'dropoff_after_pickup', (SELECT count(*) FROM trips
        WHERE NOT (dropoff_datetime > pickup_datetime)), 'error' UNION ALL
SELECT 'known_zone', (SELECT count(*) FROM trips
        WHERE pickup_location_id NOT IN (SELECT locationid FROM zones)), 'error' UNION ALL
SELECT 'payment_codes', (SELECT count(*) FROM (SELECT DISTINCT payment_type FROM trips
        WHERE payment_type NOT IN (1, 2, 3, 4, 6))), 'error')
SELECT name, failures, severity, CASE WHEN name = 'payment_codes' THEN
        CASE WHEN failures > 100 THEN 'error' WHEN failures > 1 THEN 'warn' ELSE 'pass' END
    WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM counted""")
def dq_suite(spark, sf_dir):
    trips, zones = t.trips(spark, sf_dir, exact=True), marts.dim_zones(t.zones(spark, sf_dir))
    return dq.run_suite([
        dq.Check("vendor_not_null", trips, dq.fails_not_null("vendor_id")),
        dq.Check("fare_positive", trips, dq.fails_expression("fare_amount > 0")),
        dq.Check("distance_range", trips, dq.fails_range("trip_distance", 0, 100),
                 where="service_type = 'Green'", severity="warn"),
        dq.Check("dropoff_after_pickup", trips,
                 dq.fails_expression("dropoff_datetime > pickup_datetime")),
        dq.Check("known_zone", failing=lambda: dq.relationships(
            trips, "pickup_location_id", zones, "location_id")),
        dq.Check("payment_codes", failing=lambda: dq.accepted_values(
            trips, "payment_type", [1, 2, 3, 4, 6]), warn_if="> 1", error_if="> 100"),
    ])
