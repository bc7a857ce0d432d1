"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.columns import nullcheck_table, rename_common, star, unpivot
from ..plans import marts, staging
from . import _tables as t
from ._registry import query


@query("project_columns", "SELECT o_orderkey, o_custkey FROM orders")
def project_columns(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


@query("rename_common", "SELECT o_orderkey AS trip_id, o_orderdate AS pickup_datetime, "
                        "o_custkey AS location_id FROM orders")
def rename(spark, sf_dir):
    return rename_common(t.table(spark, sf_dir, "orders"), {
        "o_orderkey": "trip_id", "o_orderdate": "pickup_datetime", "o_custkey": "location_id",
    }).select("trip_id", "pickup_datetime", "location_id")


@query("stage_trips", f"WITH {t.STAGED_SQL} SELECT * FROM stg_green")
def stage_trips(spark, sf_dir):
    return staging.stage_trips(t.raw_green(spark, sf_dir), staging.GREEN)


@query("stage_trips_yellow", f"WITH {t.STAGED_SQL} SELECT * FROM stg_yellow")
def stage_trips_yellow(spark, sf_dir):
    return staging.stage_trips(t.raw_yellow(spark, sf_dir), staging.YELLOW)


@query("stage_filter", f"WITH {t.STAGED_SQL} SELECT * FROM kept_green")
def stage_filter(spark, sf_dir):
    return t.staged(spark, sf_dir)[0]


@query("stage_filter_yellow", f"WITH {t.STAGED_SQL} SELECT * FROM kept_yellow")
def stage_filter_yellow(spark, sf_dir):
    return t.staged(spark, sf_dir)[1]


@query("file_month_check", f"""WITH {t.STAGED_SQL}
SELECT file_name, pickup_datetime,
       strftime(pickup_datetime, '%Y-%m') = regexp_extract(file_name, '[0-9]{{4}}-[0-9]{{2}}')
           AS month_matches
FROM stg_green""")
def file_month_check(spark, sf_dir):
    rows = staging.stage_trips(t.raw_green(spark, sf_dir), staging.GREEN)
    return rows.select("file_name", "pickup_datetime",
                       staging.file_month_matches().alias("month_matches"))


@query("dev_window", f"""WITH {t.STAGED_SQL} SELECT * FROM kept_green
WHERE pickup_datetime >= TIMESTAMP '1997-01-01' AND pickup_datetime < TIMESTAMP '1997-02-01'""")
def dev_window(spark, sf_dir):
    return staging.stage_feed(t.raw_green(spark, sf_dir), staging.GREEN, "1997-01-01", "1997-02-01")


@query("clean_filter_audit", f"""WITH {t.TRIPS_SQL}
SELECT count(*) AS rows_before,
       count(*) FILTER (trip_distance > 60 AND passenger_count > 2 AND fare_amount > 0) AS rows_after
FROM trips""")
def clean_filter_audit(spark, sf_dir):
    # shifted, because every derived trip has a distance and a passenger
    shifted = t.trips(spark, sf_dir, exact=True).withColumns({
        "trip_distance": F.col("trip_distance") - 60, "passenger_count": F.col("passenger_count") - 2})
    return staging.clean_trips(shifted)[1]


@query("clean_filter", f"""WITH {t.TRIPS_SQL}
SELECT service_type, pickup_datetime, CAST(trip_distance - 60 AS DECIMAL(18,4)) AS trip_distance,
       fare_amount FROM trips
WHERE trip_distance > 60 AND fare_amount > 0""")
def clean_filter(spark, sf_dir):
    shifted = t.trips(spark, sf_dir, exact=True).withColumn(
        "trip_distance", (F.col("trip_distance") - 60).cast("decimal(18,4)"))
    return staging.clean_trips(shifted)[0].select("service_type", "pickup_datetime", "trip_distance",
                                                  "fare_amount")


@query("zero_value_count", "SELECT count(*) AS n_zero FROM lineitem WHERE l_discount = 0")
def zero_value_count(spark, sf_dir):
    return (t.table(spark, sf_dir, "lineitem").where("l_discount = 0")
            .agg(F.count("*").alias("n_zero")))


@query("count_on_day", """SELECT count(*) AS n_rows FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""")
def count_on_day(spark, sf_dir):
    day = staging.date_window(t.event_rows(spark, sf_dir), "ts", "2024-01-15", "2024-01-16")
    return day.agg(F.count("*").alias("n_rows"))


@query("count_over_threshold", "SELECT count(*) AS n_rows FROM events WHERE coalesce(value, 0) > 5.0")
def count_over_threshold(spark, sf_dir):
    return (t.event_rows(spark, sf_dir).where(F.coalesce("value", F.lit(0.0)) > 5.0)
            .agg(F.count("*").alias("n_rows")))


@query("star_except", "SELECT * EXCLUDE (l_shipdate, l_tax) FROM lineitem")
def star_except(spark, sf_dir):
    df = t.table(spark, sf_dir, "lineitem")
    return df.select(*star(df, exclude=["L_SHIPDATE", "l_tax"]))


@query("star_prefix_suffix", """SELECT n_nationkey AS d_n_nationkey_x, n_name AS d_n_name_x,
n_regionkey AS d_n_regionkey_x FROM nation""")
def star_prefix_suffix(spark, sf_dir):
    df = t.table(spark, sf_dir, "nation").alias("n")
    return df.select(*star(df, prefix="d_", suffix="_x", relation_alias="n"))


@query("dim_zones", f"""WITH {t.ZONES_SQL}
SELECT locationid AS location_id, borough, zone, service_zone FROM zones""")
def dim_zones(spark, sf_dir):
    return marts.dim_zones(t.zones(spark, sf_dir))


@query("nullcheck_table", """SELECT o_orderkey, nullif(o_orderstatus, '') AS o_orderstatus,
nullif(priority, '') AS priority
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority FROM orders)""")
def nullcheck(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("priority"))
    return nullcheck_table(orders)


@query("unpivot", """
SELECT c_custkey, 'c_name' AS field_name, c_name AS value FROM customer UNION ALL
SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL
SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer UNION ALL
SELECT c_custkey, 'in_debt', CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END FROM customer""")
def unpivot_customers(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").withColumn("in_debt", F.col("c_acctbal") < 0)
    return unpivot(customers, exclude=["c_custkey"], remove=["C_ACCTBAL"])


@query("unpivot_numbers", """
SELECT o_orderkey, 'o_custkey' AS measure, CAST(o_custkey AS DECIMAL(18,2)) AS amount FROM orders
UNION ALL SELECT o_orderkey, 'o_totalprice', CAST(o_totalprice AS DECIMAL(18,2)) FROM orders""")
def unpivot_numbers(spark, sf_dir):
    return unpivot(t.table(spark, sf_dir, "orders"), exclude=["o_orderkey"],
                   remove=["o_orderstatus", "o_orderdate", "o_orderpriority"],
                   cast_to="decimal(18,2)", field_name="measure", value_name="amount")
