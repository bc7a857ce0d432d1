"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import join_dimension_twice, orphans
from ..plans import marts, reports
from . import _tables as t
from ._registry import query


@query("join_inner_rarest", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}
SELECT zone, count(*) AS pickup_count FROM trips JOIN zones ON pickup_location_id = locationid
GROUP BY zone ORDER BY pickup_count, zone LIMIT 1""")
def join_inner_rarest(spark, sf_dir):
    return reports.rarest_zone(t.trips(spark, sf_dir), marts.dim_zones(t.zones(spark, sf_dir)))


@query("join_dim_twice", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}
SELECT pickup_datetime, dropoff_datetime, total_amount, zpu.zone AS pickup_zone,
       zdo.zone AS dropoff_zone
FROM trips JOIN zones zpu ON pickup_location_id = zpu.locationid
JOIN zones zdo ON dropoff_location_id = zdo.locationid
ORDER BY pickup_datetime, dropoff_datetime, total_amount, pickup_zone, dropoff_zone LIMIT 100""")
def join_dim_twice(spark, sf_dir):
    rows = t.trips(spark, sf_dir, exact=True).select("pickup_datetime", "dropoff_datetime",
                                                     "total_amount", "pickup_location_id", "dropoff_location_id")
    joined = join_dimension_twice(rows, t.zones(spark, sf_dir), "locationid", "pickup_location_id",
                                  "dropoff_location_id", {"zone": "zone"}, ("pickup_", "dropoff_"),
                                  how="inner")
    columns = ["pickup_datetime", "dropoff_datetime", "total_amount", "pickup_zone", "dropoff_zone"]
    return joined.select(*columns).orderBy(*columns).limit(100)


@query("fct_trips", f"WITH {t.FACT_SQL} SELECT * FROM fct")
def fct_trips(spark, sf_dir):
    return t.fact(spark, sf_dir)


@query("enrich_lookup_default", f"""WITH {t.TRIPS_SQL}, {t.PAYMENT_SQL}
SELECT t.pickup_datetime, t.pickup_location_id, coalesce(t.payment_type, 0) AS payment_type,
       coalesce(description, 'Unknown') AS payment_type_description
FROM (SELECT pickup_datetime, pickup_location_id, nullif(payment_type, 3) AS payment_type FROM trips) t
LEFT JOIN payments p ON coalesce(t.payment_type, 0) = p.payment_type""")
def enrich_lookup_default(spark, sf_dir):
    rows = t.trips(spark, sf_dir).select(
        "pickup_datetime", "pickup_location_id",
        F.nullif("payment_type", F.lit(3)).alias("payment_type"))
    return marts.with_payment_text(rows, t.payment_types(spark))


def hourly_events(spark, sf_dir, event_type=None):
    """Event values per hour and user from a start date: the hourly revenue report."""
    rows = t.event_rows(spark, sf_dir)
    rows = rows if event_type is None else rows.where(F.col("event_type") == event_type)
    return reports.hourly_revenue(rows, "ts", "user_id", "value", "2024-01-05 00:00:00")


def _hourly_sql(event_type: str) -> str:
    return f"""(SELECT date_trunc('hour', ts) AS hour, user_id AS zone,
        CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,2)) AS amount,
        count(*) AS number_records
 FROM events WHERE event_type = '{event_type}' AND ts >= TIMESTAMP '2024-01-05' GROUP BY ALL)"""


HOURLY_BOTH_SQL = f"""SELECT hour, zone, g.amount AS green_amount,
    g.number_records AS green_number_records, y.amount AS yellow_amount,
    y.number_records AS yellow_number_records
FROM {_hourly_sql('click')} g FULL JOIN {_hourly_sql('view')} y USING (hour, zone)"""


def hourly_both(spark, sf_dir):
    return reports.hourly_revenue_both(hourly_events(spark, sf_dir, "click"),
                                       hourly_events(spark, sf_dir, "view"))


@query("join_full_outer", HOURLY_BOTH_SQL)
def join_full_outer(spark, sf_dir):
    return hourly_both(spark, sf_dir)


@query("join_drop_keys", f"""WITH {t.ZONES_SQL}
SELECT r.* EXCLUDE (zone), z.borough, z.zone AS zone_name, z.service_zone
FROM ({HOURLY_BOTH_SQL}) r JOIN zones z ON r.zone = z.locationid""")
def join_drop_keys(spark, sf_dir):
    return reports.with_zone_names(hourly_both(spark, sf_dir),
                                   marts.dim_zones(t.zones(spark, sf_dir)))


@query("relationships_where", f"""WITH {t.TRIPS_SQL}, {t.ZONES_SQL}
SELECT pickup_location_id, pickup_datetime FROM trips
WHERE pickup_location_id <> 5 AND pickup_location_id NOT IN
      (SELECT locationid FROM zones WHERE service_zone = 'Boro Zone')""")
def relationships_where(spark, sf_dir):
    return orphans(t.trips(spark, sf_dir), t.zones(spark, sf_dir), "pickup_location_id", "locationid",
                   "pickup_location_id <> 5", "service_zone = 'Boro Zone'").select(
        "pickup_location_id", "pickup_datetime")
