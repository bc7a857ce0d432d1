"""Whole runs, from paths to written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_text, row_fingerprint
from ..operators.incremental import merge_partitions, rows_above_high_water
from ..sources.committed import read_committed, read_snapshot, snapshot
from ..sources.readers import read_csv, read_parquet, with_lineage
from ..sources.writers import write_by_month, write_single_file, write_table
from . import marts, reports, staging

MONTH = "pickup_month"


def load_feed(spark: SparkSession, path: str, feed: staging.Feed, delimiter: str = "-") -> DataFrame:
    """CSV files of one feed (a folder or glob), with each row's fingerprint and file name."""
    return with_lineage(read_csv(spark, path, feed.schema), row_fingerprint(feed.natural_key, delimiter))


def backfill(spark: SparkSession, path: str, feed: staging.Feed, out: str) -> None:
    """All months of a feed in one job, from CSV to Parquet by service, year and month. Running it
    again, or for some months only, replaces just the months it reads."""
    write_by_month(load_feed(spark, path, feed), out, feed.pickup, F.lit(feed.service))


def build_fact(green: DataFrame, yellow: DataFrame, payment_types: DataFrame, zones: DataFrame,
               start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw feeds to the fact, as one lazy plan."""
    unioned = staging.union_services(staging.stage_feed(green, staging.GREEN, start, end),
                                     staging.stage_feed(yellow, staging.YELLOW, start, end))
    return marts.fct_trips(marts.unique_trips(unioned, payment_types), marts.dim_zones(zones))


def refresh_fact(spark: SparkSession, fact: DataFrame, root: str, look_back: str | None = None,
                 ) -> list[str]:
    """Merge the newer rows of the fact into the stored table, by trip id.

    The table is partitioned by pickup month, which the trip id determines: only the newest month
    is read for the high-water mark, and only months with new rows are rewritten. Returns them. All months
    change with one commit, so readers never see half a refresh.
    """
    rows = fact.withColumn(MONTH, month_text("pickup_datetime"))
    stored = snapshot(spark, root)
    if stored.loads:
        newest = read_snapshot(spark, root, stored, [max(stored.loads)]).select("pickup_datetime")
        rows = rows_above_high_water(rows, newest, "pickup_datetime", look_back)
    return merge_partitions(spark, rows, root, "trip_id", MONTH)


def stored_fact(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The stored fact as of its newest or a given commit; columns that older months do not have are NULL there."""
    return read_committed(spark, root, version)


def build_reports(spark: SparkSession, fact_root: str, out: str) -> None:
    """Write the monthly mart and the vendor dimension from the stored fact."""
    fact = stored_fact(spark, fact_root)
    write_table(reports.monthly_zone_revenue(fact), f"{out}/monthly_zone_revenue")
    write_single_file(marts.dim_vendors(fact), f"{out}/dim_vendors")


def monthly_revenue_job(spark: SparkSession, green_path: str, yellow_path: str, target: str,
                        file_format: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Monthly revenue straight from the two Parquet trees, to a warehouse table or path."""
    def common(path: str, feed: staging.Feed) -> DataFrame:
        rows = read_parquet(spark, path, recursive=True)
        return rows.withColumnsRenamed({feed.pickup: "pickup_datetime", feed.dropoff: "dropoff_datetime",
                                        "PULocationID": "pickup_location_id"})

    green, yellow = common(green_path, staging.GREEN), common(yellow_path, staging.YELLOW)
    shared = [c for c in green.columns if c in set(yellow.columns)]
    trips = tagged_union(green.select(*shared), yellow.select(*shared))
    write_table(reports.monthly_revenue_decimal(trips), target, file_format, options=options)


def tagged_union(green: DataFrame, yellow: DataFrame) -> DataFrame:
    return (green.withColumn("service_type", F.lit("green"))
            .unionByName(yellow.withColumn("service_type", F.lit("yellow"))))
