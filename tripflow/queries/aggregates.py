"""Aggregations, top-k and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import profile, sketches
from ..plans import marts, reports
from ..schemas import MONEY_COLUMNS, VENDOR_NAMES
from ..session import work_dir
from ..sources import readers, writers
from . import _tables as t
from ._registry import query
from .joins import hourly_events


@query("count_all", "SELECT count(*) AS total_records FROM lineitem")
def count_all(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("total_records"))


@query("count_distinct", "SELECT count(DISTINCT l_suppkey) AS n_suppliers, "
                         "count(DISTINCT l_partkey) AS n_parts FROM lineitem")
def count_distinct(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem").agg(
        F.count_distinct("l_suppkey").alias("n_suppliers"), F.count_distinct("l_partkey").alias("n_parts"))


@query("distinct_by_sketch", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n_rows,
    count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_partkey) AS n_parts, true AS suppliers_close,
    true AS parts_close FROM lineitem GROUP BY 1""")
def distinct_by_sketch(spark, sf_dir):
    """Daily sketches, stored, and merged by month, next to exact counts: are they within the bound?"""
    lines, columns = t.table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"]
    path, month = work_dir(spark, "sketches"), F.to_date(F.date_trunc("month", "day")).alias("month")
    writers.convert_to_parquet(sketches.day_sketches(lines, "l_shipdate", columns), path)
    merged = sketches.merged_counts(readers.read_parquet(spark, path), columns, [month])
    exact = lines.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        F.count_distinct("l_suppkey").alias("n_suppliers"), F.count_distinct("l_partkey").alias("n_parts"))
    close = lambda n, c: F.abs(F.col(c) - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * sketches.error_bound())
    return merged.join(exact, "month").select("month", "n_rows", "n_suppliers", "n_parts",
                                              close("n_suppliers", "l_suppkey").alias("suppliers_close"),
                                              close("n_parts", "l_partkey").alias("parts_close"))


@query("distinct_in_range", """SELECT DISTINCT l_suppkey FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-15'""")
def distinct_in_range(spark, sf_dir):
    return (t.table(spark, sf_dir, "lineitem")
            .where("l_shipdate BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-15'")
            .select("l_suppkey").distinct())


HOURLY_SQL = """SELECT date_trunc('hour', ts) AS hour, user_id AS zone,
    CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,2)) AS amount, count(*) AS number_records
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY ALL"""


@query("hourly_revenue", HOURLY_SQL)
def hourly_revenue(spark, sf_dir):
    return hourly_events(spark, sf_dir)


@query("hourly_revenue_trips", f"""WITH {t.TRIPS_SQL}
SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_location_id AS zone,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount, count(*) AS number_records
FROM trips WHERE pickup_datetime >= TIMESTAMP '1998-01-01' GROUP BY ALL""")
def hourly_revenue_trips(spark, sf_dir):
    return reports.hourly_revenue(t.trips(spark, sf_dir), "pickup_datetime", "pickup_location_id",
                                  "total_amount", "1998-01-01 00:00:00")


_SUMS_SQL = ",\n".join(
    f"CAST(sum({c}) AS DECIMAL(18,2)) AS revenue_monthly_{'fare' if c == 'fare_amount' else c}"
    for c in MONEY_COLUMNS)


@query("monthly_revenue_decimal", f"""WITH {t.TRIPS_SQL}
SELECT revenue_zone, revenue_month, service_type, r.* EXCLUDE (revenue_zone, revenue_month,
       service_type, avg_monthly_passenger_count, avg_monthly_trip_distance),
       round(avg_monthly_passenger_count, 9) AS avg_monthly_passenger_count,
       round(avg_monthly_trip_distance, 9) AS avg_monthly_trip_distance
FROM (SELECT pickup_location_id AS revenue_zone, CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP)
          AS revenue_month, service_type, {_SUMS_SQL},
          avg(passenger_count) AS avg_monthly_passenger_count,
          avg(CAST(trip_distance AS DOUBLE)) AS avg_monthly_trip_distance
      FROM trips GROUP BY ALL) r""")
def monthly_revenue_decimal(spark, sf_dir):
    # averages are rounded: the last bits of a double depend on the order of the rows
    report = reports.monthly_revenue_decimal(t.trips(spark, sf_dir))
    return report.withColumns({c: F.round(c, 9) for c in report.columns if c.startswith("avg_")})


# mean of a four-digit decimal, rounded half up to two digits in whole numbers
_MEAN_DISTANCE_SQL = ("(2 * CAST(sum(trip_distance) * 10000 AS HUGEINT) + 100 * count(*)) "
                      "// (200 * count(*))")


@query("monthly_report", f"""WITH {t.TRIPS_SQL}
SELECT pickup_location_id AS zone, strftime(pickup_datetime, '%Y-%m') AS month, service_type AS type,
       CAST(sum(fare_amount) AS DECIMAL(18,2)) AS fare, CAST(sum(tip_amount) AS DECIMAL(18,2)) AS tips,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS total,
       round(avg(passenger_count), 1) AS avg_passengers,
       CAST({_MEAN_DISTANCE_SQL} AS DOUBLE) / 100 AS avg_distance
FROM trips GROUP BY ALL ORDER BY zone, month DESC, type""")
def monthly_report(spark, sf_dir):
    return reports.monthly_report(t.trips(spark, sf_dir))


@query("daily_stats", f"""WITH {t.TRIPS_SQL}
SELECT pickup_location_id AS pickup_zone_id,
       CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS pickup_day, service_type,
       count(*) AS total_trips, CAST(sum(total_amount) AS DECIMAL(18,2)) AS daily_revenue,
       CAST(CAST({_MEAN_DISTANCE_SQL} AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) AS avg_distance
FROM trips GROUP BY ALL""")
def daily_stats(spark, sf_dir):
    return reports.daily_stats(t.trips(spark, sf_dir))


MART_SQL = f"""WITH {t.FACT_SQL}
SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
       CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month, service_type,
       {', '.join(f'CAST(sum({c}) AS DECIMAL(28,9)) AS revenue_monthly_{c}' for c in MONEY_COLUMNS)},
       count(trip_id) AS total_monthly_trips,
       round(avg(passenger_count), 6) AS avg_monthly_passenger_count,
       round(avg(trip_distance), 6) AS avg_monthly_trip_distance
FROM fct GROUP BY ALL"""


def monthly_mart(fact):
    return rounded_means(reports.monthly_zone_revenue(fact))


def rounded_means(mart):
    return mart.withColumns({c: F.round(F.col(c).cast("double"), 6)
                             for c in mart.columns if c.startswith("avg_")})


@query("monthly_zone_revenue", MART_SQL)
def monthly_zone_revenue(spark, sf_dir):
    trips = marts.first_trips(t.unioned(spark, sf_dir))
    return rounded_means(reports.monthly_zone_revenue_of_trips(trips, marts.dim_zones(t.zones(spark, sf_dir))))


@query("count_by_service", f"WITH {t.TRIPS_SQL} SELECT service_type, count(*) AS n_trips "
                           "FROM trips GROUP BY service_type")
def count_by_service(spark, sf_dir):
    return t.trips(spark, sf_dir).groupBy("service_type").agg(F.count("*").alias("n_trips"))


@query("longest_duration", f"""WITH {t.TRIPS_SQL}
SELECT max(epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0 AS longest_trip_hours FROM trips""")
def longest_duration(spark, sf_dir):
    return reports.longest_trip(t.trips(spark, sf_dir))


@query("avg_by_group", """SELECT p_brand, round(avg(CAST(p_retailprice AS DECIMAL(12,2))), 2) AS avg_price
FROM part GROUP BY p_brand ORDER BY avg_price DESC, p_brand""")
def avg_by_group(spark, sf_dir):
    price = F.avg(F.col("p_retailprice").cast("decimal(12,2)")).cast("double")
    return (t.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.round(price, 2).alias("avg_price"))
            .orderBy(F.desc("avg_price"), "p_brand"))


@query("reduce_by_key", """SELECT date_trunc('hour', ts) AS hour, user_id AS zone,
    CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(10,2)) AS revenue, CAST(count(*) AS INTEGER) AS count
FROM events GROUP BY ALL""")
def reduce_by_key(spark, sf_dir):
    return reports.revenue_pairs(t.event_rows(spark, sf_dir), "ts", "user_id", "value")


@query("group_by_ordinal", """SELECT o_orderstatus, o_orderpriority, count(*) AS n_rows
FROM orders GROUP BY 1, 2""")
def group_by_ordinal(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    return agg.group_by_first(orders, 2).agg(F.count("*").alias("n_rows"))


@query("pivot_sum", """SELECT user_id,
    sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click,
    sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS view,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS error
FROM events GROUP BY user_id""")
def pivot_sum(spark, sf_dir):
    return t.event_rows(spark, sf_dir).groupBy("user_id").agg(
        *agg.pivot("event_type", ["click", "view", "error"]))


@query("pivot_custom", """SELECT o_orderstatus,
    count(DISTINCT CASE WHEN o_totalprice >= 100000 THEN o_custkey ELSE -1 END) AS buyers_100000_up,
    count(DISTINCT CASE WHEN o_totalprice >= 300000 THEN o_custkey ELSE -1 END) AS buyers_300000_up
FROM orders GROUP BY o_orderstatus""")
def pivot_custom(spark, sf_dir):
    measures = agg.pivot("o_totalprice", [100000, 300000], agg="count", cmp=">=", prefix="Buyers ",
                         suffix="-up", then_value=F.col("o_custkey"), else_value=-1,
                         quote_identifiers=False, distinct=True)
    return t.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(*measures)


@query("pivot_from_values", """SELECT c_mktsegment,
    max(CASE WHEN c_nationkey = 0 THEN c_acctbal ELSE 0 END) AS n_0,
    max(CASE WHEN c_nationkey = 1 THEN c_acctbal ELSE 0 END) AS n_1,
    max(CASE WHEN c_nationkey = 2 THEN c_acctbal ELSE 0 END) AS n_2
FROM customer GROUP BY c_mktsegment""")
def pivot_from_values(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer")
    keys = agg.column_value_list(customers, "c_nationkey", max_records=3, where="c_nationkey < 3")
    return customers.groupBy("c_mktsegment").agg(
        *agg.pivot("c_nationkey", sorted(keys), agg="max", prefix="n_", then_value=F.col("c_acctbal"),
                   else_value=0.0))


@query("column_values", """SELECT l_partkey AS value, count(*) AS n_rows FROM lineitem
WHERE l_quantity > 10 GROUP BY l_partkey ORDER BY n_rows DESC, value LIMIT 50""")
def column_values(spark, sf_dir):
    return agg.column_values(t.table(spark, sf_dir, "lineitem"), "l_partkey", max_records=50,
                             where="l_quantity > 10")


@query("single_value", "SELECT coalesce(max(o_orderdate), TIMESTAMP '1970-01-01') AS newest FROM orders")
def single_value(spark, sf_dir):
    newest = agg.single_value(t.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("string")),
                              default="1970-01-01 00:00:00")
    return spark.range(1).select(F.lit(newest).cast("timestamp").alias("newest"))


@query("results_as_dict", """SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n_orders,
    CAST(max(o_orderkey) AS BIGINT) AS last_order FROM orders GROUP BY 1""")
def results_as_dict(spark, sf_dir):
    """A small result as lists per column, with a limit, and back as rows."""
    found = t.table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n_orders"), F.max("o_orderkey").alias("last_order"))
    lists = agg.results_as_dict(found, max_rows=100)
    return spark.createDataFrame(list(zip(*(lists[c] for c in found.columns))), found.schema)


@query("explode_top_values", r"""SELECT word, count(*) AS n_rows
FROM (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word ORDER BY n_rows DESC, word LIMIT 20""")
def explode_top_values(spark, sf_dir):
    words = F.split(F.lower("text"), r"\s+")
    return agg.explode_top_values(t.table(spark, sf_dir, "documents"), words, 20, value_name="word",
                                  where="word <> ''")


@query("skew_check", """SELECT o_custkey, o_orderstatus, count(*) AS n_rows FROM orders
GROUP BY ALL ORDER BY n_rows DESC, o_custkey, o_orderstatus LIMIT 5""")
def skew_check(spark, sf_dir):
    return agg.skew_check(t.table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"])


@query("column_profile", """SELECT bucket, count(*) AS n_rows,
    round(avg(CAST(l_extendedprice AS DECIMAL(18,2))), 4) AS avg_measure,
    round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
FROM (SELECT *, CASE WHEN l_quantity < 10 THEN '1 short' WHEN l_quantity < 40 THEN '2 standard'
                     ELSE '3 long' END AS bucket FROM lineitem)
GROUP BY bucket""")
def column_profile(spark, sf_dir):
    quantity = F.col("l_quantity")
    bucket = F.when(quantity < 10, "1 short").when(quantity < 40, "2 standard").otherwise("3 long")
    profile = agg.column_profile(t.table(spark, sf_dir, "lineitem"), bucket,
                                 F.col("l_extendedprice").cast("decimal(18,2)"))
    return profile.withColumns({"avg_measure": F.round(F.col("avg_measure").cast("double"), 4),
                                "share": F.round("share", 6)})


_PROFILED = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
             "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
             "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp"}


def _profile_sql(column: str, kind: str) -> str:
    text, number = kind == "string", kind not in ("string", "timestamp")
    return f"""SELECT '{column}' AS "column", '{kind}' AS type, count(*) AS n_rows, count(*) - count({column}) AS n_null,
    {f"count(*) FILTER (trim({column}) = '')" if text else 'CAST(NULL AS BIGINT)'} AS n_blank,
    CAST(min({column}) AS VARCHAR) AS least, CAST(max({column}) AS VARCHAR) AS most,
    {f'round(avg({column}), 3)' if number else 'CAST(NULL AS DOUBLE)'} AS mean FROM lineitem"""


@query("profile_columns", " UNION ALL ".join(_profile_sql(c, k) for c, k in _PROFILED.items()))
def profile_columns(spark, sf_dir):
    """All columns at once from stored sketches per line number, merged; the exact parts."""
    path = work_dir(spark, "profile")
    writers.convert_to_parquet(profile.column_sketches(t.table(spark, sf_dir, "lineitem"), ["l_linenumber"]), path)
    found = profile.profile(spark.read.parquet(path))
    return found.withColumn("mean", F.round("mean", 3)).select(
        "column", "type", "n_rows", "n_null", "n_blank", "least", "most", "mean")


_TOP_SQL = " UNION ALL ".join(f"""SELECT '{c}' AS "column", value, n FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n
    FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 3)""" for c in ("l_returnflag", "l_linestatus", "l_linenumber"))


@query("profile_top_values", _TOP_SQL)
def profile_top_values(spark, sf_dir):
    """The commonest values of some columns, exact where a column has few."""
    found = profile.profile_table(t.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], top=3)
    return found.select("column", F.inline("top_values")).select("column", F.col("item").alias("value"), F.col("count").alias("n"))


@query("dim_vendors", f"""WITH {t.FACT_SQL}
SELECT DISTINCT vendor_id, CASE vendor_id
    {' '.join(f"WHEN {k} THEN '{v}'" for k, v in VENDOR_NAMES.items())} END AS vendor_name FROM fct""")
def dim_vendors(spark, sf_dir):
    return marts.dim_vendors(t.fact(spark, sf_dir))


@query("limit_preview", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 50""")
def limit_preview(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return t.table(spark, sf_dir, "lineitem").select(*columns).orderBy(*columns).limit(50)


@query("top_k_groups", """SELECT l_suppkey, count(*) AS n_rows FROM lineitem
GROUP BY l_suppkey ORDER BY n_rows, l_suppkey LIMIT 10""")
def top_k_groups(spark, sf_dir):
    return agg.top_groups(t.table(spark, sf_dir, "lineitem"), ["l_suppkey"], 10, ascending=True)
