"""Deduplication, set operations and generators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import boundary_diff
from ..operators import dedup, generators, sets
from ..plans import marts
from ..schemas import SOURCE_COLUMN
from ..sources.catalog import relations_by_prefix
from . import _tables as t
from ._registry import query

_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"


@query("dedup_first", f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""")
def dedup_first(spark, sf_dir):
    return dedup.keep_first(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                            _LINE_ORDER.split(", "))


@query("dedup_min_by", f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""")
def dedup_min_by(spark, sf_dir):
    return dedup.keep_min_by(t.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                             F.struct(*_LINE_ORDER.split(", ")))


@query("dedup_trips", f"WITH {t.UNIQUE_SQL} SELECT * FROM unique_trips")
def dedup_trips(spark, sf_dir):

    return marts.unique_trips(t.unioned(spark, sf_dir), t.payment_types(spark))


@query("union_services", f"WITH {t.UNIONED_SQL} SELECT * FROM unioned")
def union_services(spark, sf_dir):
    return t.unioned(spark, sf_dir)


@query("union_relations", f"""
SELECT 'customer' AS {SOURCE_COLUMN}, c_custkey AS id, c_name AS name, c_nationkey AS nationkey,
       c_acctbal AS acctbal, c_mktsegment AS segment FROM customer UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_relations(spark, sf_dir):
    return sets.union_relations(_parties(spark, sf_dir))


def _parties(spark, sf_dir):
    return {
        "customer": t.table(spark, sf_dir, "customer").toDF("id", "name", "nationkey", "acctbal", "segment"),
        "supplier": t.table(spark, sf_dir, "supplier").toDF("id", "name", "nationkey", "acctbal"),
    }


@query("union_exclude", """
SELECT 'customer' AS origin, c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS nationkey,
       c_mktsegment AS segment FROM customer UNION ALL
SELECT 'supplier', s_suppkey, CAST(s_nationkey AS VARCHAR), NULL FROM supplier""")
def union_exclude(spark, sf_dir):
    return sets.union_relations(_parties(spark, sf_dir), exclude=["NAME", "acctbal"],
                                column_override={"nationkey": "string"}, source_column_name="origin")


@query("union_where", """
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey = 3 UNION ALL
SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3""")
def union_where(spark, sf_dir):
    return sets.union_relations(_parties(spark, sf_dir), include=["id", "name"],
                                source_column_name=None, where="nationkey = 3")


@query("union_by_prefix", f"""
SELECT 'trade_customer' AS {SOURCE_COLUMN}, c_custkey AS id, c_name AS name,
       c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer UNION ALL
SELECT 'trade_supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_by_prefix(spark, sf_dir):
    # names of this call alone, so that nothing else in the session's catalog matches
    tag = f"trade{uuid.uuid4().hex}_"
    for name, df in _parties(spark, sf_dir).items():
        df.createOrReplaceTempView(f"{tag}{name}")
    t.table(spark, sf_dir, "nation").createOrReplaceTempView(f"{tag}nation")
    found = relations_by_prefix(spark, tag.upper(), exclude="%nation")
    return sets.union_relations({f"trade_{k.removeprefix(tag)}": v for k, v in found.items()})


@query("set_difference", """
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT l_partkey AS k, l_suppkey AS s FROM lineitem
    WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'A')
UNION ALL
SELECT 'b_minus_a', * FROM (SELECT l_partkey AS k, l_suppkey AS s FROM lineitem
    WHERE l_returnflag <> 'A' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')""")
def set_difference(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    pairs = [F.col("l_partkey").alias("k"), F.col("l_suppkey").alias("s")]
    return sets.one_sided_rows(lines.where("l_returnflag = 'A'").select(*pairs),
                               lines.where("l_returnflag <> 'A'").select(*pairs))


@query("generate_series", """SELECT unnest(generate_series(1, (SELECT count(*) FROM orders)))
    AS generated_number""")
def generate_series(spark, sf_dir):
    return generators.generate_series(spark, t.table(spark, sf_dir, "orders").count())


@query("date_spine", """SELECT CAST(unnest(generate_series(
    (SELECT min(date_trunc('day', ts)) FROM events),
    (SELECT max(date_trunc('day', ts)) FROM events) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS TIMESTAMP)
    AS date_day""")
def date_spine(spark, sf_dir):
    start, end = t.event_rows(spark, sf_dir).agg(
        F.min(F.date_trunc("day", "ts")).cast("string"), F.max(F.date_trunc("day", "ts")).cast("string")).head()
    return generators.date_spine(spark, "day", start, end)


@query("date_spine_over", """
SELECT user_id, CAST(unnest(generate_series(first_hour, last_hour - INTERVAL 1 HOUR, INTERVAL 1 HOUR))
    AS TIMESTAMP) AS date_hour
FROM (SELECT user_id, date_trunc('hour', min(ts)) AS first_hour, date_trunc('hour', max(ts)) AS last_hour
      FROM events GROUP BY user_id)""")
def date_spine_over(spark, sf_dir):
    bounds = t.event_rows(spark, sf_dir).groupBy("user_id").agg(
        F.date_trunc("hour", F.min("ts")).alias("start"), F.date_trunc("hour", F.max("ts")).alias("end"))
    return generators.date_spine_over(bounds, "hour")


@query("intervals_between", """SELECT event_id,
    date_diff('hour', TIMESTAMP '2024-01-01', ts) AS hours,
    date_diff('day', TIMESTAMP '2023-12-31 23:00:00', ts) AS days,
    date_diff('day', date_trunc('week', TIMESTAMP '2023-12-31'), date_trunc('week', ts)) // 7 AS weeks,
    date_diff('month', TIMESTAMP '2023-11-30', ts) AS months,
    date_diff('quarter', TIMESTAMP '2023-03-31', ts) AS quarters,
    date_diff('year', TIMESTAMP '2020-12-31', ts) AS years
FROM events""")
def intervals_between(spark, sf_dir):
    def since(part: str, moment: str):
        return boundary_diff(part, F.lit(moment).cast("timestamp"), "ts").alias(f"{part}s")

    return t.event_rows(spark, sf_dir).select(
        "event_id", since("hour", "2024-01-01"), since("day", "2023-12-31 23:00:00"),
        since("week", "2023-12-31"), since("month", "2023-11-30"), since("quarter", "2023-03-31"),
        since("year", "2020-12-31"))
