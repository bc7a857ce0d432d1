"""Incremental loads and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import month_text
from ..operators import incremental
from ..plans import jobs, staging
from ..schemas import NUMERIC
from ..session import work_dir
from ..sources import committed, readers, writers
from . import _tables as t
from ._registry import query
from .aggregates import MART_SQL, monthly_mart


@query("merge_insert_only", f"""WITH {t.RAW_SQL}, {t.RAW_GREEN_SQL},
timed AS (SELECT * REPLACE (CASE WHEN month(lpep_pickup_datetime) <> 7 OR RatecodeID <> '3'
              THEN lpep_pickup_datetime END AS lpep_pickup_datetime),
              month(lpep_pickup_datetime) AS load_month FROM raw_green),
first AS (SELECT * FROM timed WHERE load_month <= 8),
second AS (SELECT * FROM timed WHERE load_month >= 6)
SELECT unique_row_id, filename, lpep_pickup_datetime FROM first UNION ALL
SELECT unique_row_id, filename, lpep_pickup_datetime FROM second
WHERE unique_row_id NOT IN (SELECT unique_row_id FROM first)""")
def merge_insert_only(spark, sf_dir):
    month = F.month("lpep_pickup_datetime")
    # some rows that both loads hold have no time
    timed = F.when((month != 7) | (F.col("RatecodeID") != "3"), F.col("lpep_pickup_datetime"))
    raw = t.raw_green(spark, sf_dir).select("unique_row_id", "filename", month.alias("load_month"),
                                            timed.alias("lpep_pickup_datetime"))
    path, loads = work_dir(spark, "merged"), [work_dir(spark, "load") for _ in range(2)]
    for load, wanted in zip(loads, ["load_month <= 8", "load_month >= 6"]):
        writers.convert_to_parquet(raw.where(wanted).drop("load_month"), load)
    raw = raw.drop("load_month")
    # overlapping loads; the second load runs twice and must add nothing the second time
    writers.append_rows(readers.read_parquet(spark, loads[0], raw.schema), path)
    for _ in range(2):
        stored = readers.read_parquet(spark, path, raw.schema)
        new = incremental.insert_new(stored, readers.read_parquet(spark, loads[1], raw.schema),
                                     "unique_row_id", within="lpep_pickup_datetime")
        # written aside first: a table cannot be appended to while its old files are read
        batch = work_dir(spark, "batch")
        writers.convert_to_parquet(new, batch)
        writers.append_rows(readers.read_parquet(spark, batch, raw.schema), path)
    return readers.read_parquet(spark, path, raw.schema)


@query("merge_pruned", f"""WITH {t.RAW_SQL}, {t.RAW_GREEN_SQL},
loads AS (SELECT unique_row_id, filename, lpep_pickup_datetime, strftime(lpep_pickup_datetime, '%Y-%m') AS load_month,
                 month(lpep_pickup_datetime) AS m FROM raw_green)
SELECT unique_row_id, filename, lpep_pickup_datetime, load_month FROM loads WHERE m <= 8 UNION ALL
SELECT unique_row_id, filename, lpep_pickup_datetime, load_month FROM loads
WHERE m >= 6 AND unique_row_id NOT IN (SELECT unique_row_id FROM loads WHERE m <= 8)""")
def merge_pruned(spark, sf_dir):
    """Overlapping loads into a table committed by month; the second one runs twice, reads only the
    months it holds, and adds nothing the second time."""
    raw = t.raw_green(spark, sf_dir).select(
        "unique_row_id", "filename", "lpep_pickup_datetime", month_text("lpep_pickup_datetime").alias("load_month"))
    root, month = work_dir(spark, "merged"), F.month("lpep_pickup_datetime")
    for load in (raw.where(month <= 8), raw.where(month >= 6), raw.where(month >= 6)):
        incremental.insert_new_partitions(spark, load, root, "unique_row_id", "load_month")
    return committed.read_committed(spark, root)


@query("refresh_commits", f"""WITH {t.FACT_SQL},
versions AS (
    SELECT 0 AS version, *, CAST(0 AS DECIMAL(18,9)) AS amount FROM fct WHERE pickup_datetime < TIMESTAMP '1998-06-15'
    UNION ALL SELECT 1, *, total_amount FROM fct)
SELECT version, strftime(pickup_datetime, '%Y-%m') AS pickup_month, count(*) AS n_trips,
       count(DISTINCT trip_id) AS n_ids, CAST(sum(amount) AS DECIMAL(28,9)) AS total_amount
FROM versions GROUP BY ALL""")
def refresh_commits(spark, sf_dir):
    """A fact with wrong amounts, a refresh that breaks off after writing its months, and the refresh
    again: the table goes from its first version to the whole one, and both can be read."""
    fact, root = t.fact(spark, sf_dir), work_dir(spark, "fact")
    early = fact.where("pickup_datetime < TIMESTAMP '1998-06-15'").withColumn("total_amount", F.lit(0).cast(NUMERIC))
    jobs.refresh_fact(spark, early, root)
    broken = early.withColumn(jobs.MONTH, month_text("pickup_datetime")).withColumn("trip_id", F.lit("half"))
    committed.write_load(broken, root, jobs.MONTH)  # never committed
    jobs.refresh_fact(spark, fact, root, look_back="20 years")
    found = [jobs.stored_fact(spark, root, v).withColumn("version", F.lit(v))
             for v in committed.versions(spark, root)]
    return (found[0].unionByName(found[1]).groupBy("version", jobs.MONTH)
            .agg(F.count("*").alias("n_trips"), F.count_distinct("trip_id").alias("n_ids"),
                 F.sum("total_amount").alias("total_amount")))


@query("incremental_upsert", f"WITH {t.FACT_SQL} SELECT * FROM fct")
def incremental_upsert(spark, sf_dir):
    """Fact loaded up to mid 1998 first, with wrong amounts and without its last column, then
    brought up to date with a look-back over all of it."""
    fact, root = t.fact(spark, sf_dir), work_dir(spark, "fact")
    early = (fact.where("pickup_datetime < TIMESTAMP '1998-06-15'").drop("payment_type_description")
             .withColumn("total_amount", F.lit(0).cast(NUMERIC)))
    jobs.refresh_fact(spark, early, root)
    jobs.refresh_fact(spark, fact, root, look_back="20 years")
    return jobs.stored_fact(spark, root).drop(jobs.MONTH)


@query("incremental_new_only", f"""WITH {t.FACT_SQL}
SELECT trip_id, pickup_datetime, CASE WHEN pickup_datetime < TIMESTAMP '1998-06-15'
       THEN CAST(0 AS DECIMAL(18,9)) ELSE total_amount END AS total_amount FROM fct""")
def incremental_new_only(spark, sf_dir):
    """Without look-back only rows above the high-water mark are loaded; stored ones stay."""
    fact = t.fact(spark, sf_dir).select("trip_id", "pickup_datetime", "total_amount")
    root = work_dir(spark, "fact")
    early = (fact.where("pickup_datetime < TIMESTAMP '1998-06-15'")
             .withColumn("total_amount", F.lit(0).cast(NUMERIC)))
    jobs.refresh_fact(spark, early, root)
    jobs.refresh_fact(spark, fact, root)
    return jobs.stored_fact(spark, root).drop(jobs.MONTH)


@query("incremental_high_water", f"""WITH {t.FACT_SQL}
SELECT * FROM fct WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM fct
                                           WHERE pickup_datetime < TIMESTAMP '1998-06-15')""")
def incremental_high_water(spark, sf_dir):
    fact = t.fact(spark, sf_dir)
    stored = fact.where("pickup_datetime < TIMESTAMP '1998-06-15'")
    return incremental.rows_above_high_water(fact, stored, "pickup_datetime")


@query("upsert_rows", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END
    AS o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def upsert_rows(spark, sf_dir):
    """Known orders are F and P; the batch corrects P, brings O and adds a column."""
    orders = t.table(spark, sf_dir, "orders")
    known = orders.where("o_orderstatus IN ('F', 'P')").select("o_orderkey", "o_totalprice")
    batch = (orders.where("o_orderstatus IN ('P', 'O')")
             .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", 0.0)
                         .otherwise(F.col("o_totalprice")))
             .select("o_orderkey", "o_totalprice", "o_orderpriority"))
    return incremental.upsert(known, batch, "o_orderkey")


@query("backfill_months", f"""WITH {t.TRIPS_SQL}
SELECT lower(service_type) AS service, CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n_trips
FROM trips GROUP BY ALL""")
def backfill_months(spark, sf_dir):
    path = work_dir(spark, "months")
    trips = t.trips(spark, sf_dir).select("service_type", "pickup_datetime", "total_amount")
    writers.write_by_month(trips, path, "pickup_datetime", "service_type")
    # one year again: its months are replaced, the others stay
    writers.write_by_month(trips.where("year(pickup_datetime) = 2001"), path, "pickup_datetime",
                           "service_type")
    return (readers.read_parquet(spark, path).groupBy("service", "year", "month")
            .agg(F.count("*").alias("n_trips")))


@query("backfill_feed", f"""WITH {t.RAW_SQL}, {t.RAW_GREEN_SQL}
SELECT 'green' AS service, CAST(year(lpep_pickup_datetime) AS INTEGER) AS year,
       CAST(month(lpep_pickup_datetime) AS INTEGER) AS month, count(*) AS n_rows,
       count(DISTINCT unique_row_id) AS n_trips, max(TRY_CAST(RatecodeID AS INTEGER)) AS max_rate_code
FROM raw_green GROUP BY ALL""")
def backfill_feed(spark, sf_dir):
    """Gzipped CSV of a feed to Parquet by month, with row keys and file names."""
    csv, out = work_dir(spark, "feed"), work_dir(spark, "lake")
    raw = t.raw_green(spark, sf_dir).withColumn("ehail_fee", F.lit(None).cast("double"))
    (raw.select(*staging.GREEN.schema.fieldNames()).write.option("header", True)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("compression", "gzip").csv(csv))
    jobs.backfill(spark, csv, staging.GREEN, out)
    return (readers.read_parquet(spark, out).groupBy("service", "year", "month")
            .agg(F.count("*").alias("n_rows"), F.count_distinct("unique_row_id").alias("n_trips"),
                 F.max("RatecodeID").alias("max_rate_code")))


@query("trips_end_to_end", MART_SQL)
def trips_end_to_end(spark, sf_dir):
    """Feeds to stored fact to monthly mart."""
    root = work_dir(spark, "model")
    fact = t.fact(spark, sf_dir)
    jobs.refresh_fact(spark, fact, f"{root}/fct_trips")
    return monthly_mart(jobs.stored_fact(spark, f"{root}/fct_trips"))


@query("publish_versions", "SELECT o_orderkey, o_orderstatus FROM orders")
def publish_versions(spark, sf_dir):
    """A small table republished whole: readers see the newest complete version."""
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    root = work_dir(spark, "versions")
    incremental.publish(orders.where("o_orderstatus = 'F'"), root)
    more = incremental.insert_new(incremental.published(spark, root), orders, "o_orderkey")
    incremental.publish(incremental.published(spark, root).unionByName(more), root)
    return incremental.published(spark, root)
