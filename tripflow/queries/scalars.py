"""Column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..functions.geo import EARTH_RADIUS_MILES, PER_MILE
from ..operators.nested import decode_or_reject, json_map_to_rows
from ..operators.scoring import linear_duration_model, score_batches, score_expression
from ..schemas import SURROGATE_KEY_NULL, declared
from . import _tables as t
from ._registry import query


@query("to_dates", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS pickup_date,
    CAST(o_orderdate + INTERVAL 36 HOUR AS DATE) AS dropoff_date FROM orders""")
def to_dates(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("pickup_date"),
        F.to_date(fn.add_interval("hour", 36, "o_orderdate")).alias("dropoff_date"))


@query("duration_minutes", """SELECT event_id, user_id,
    date_diff('minute', ts, ts + to_seconds(CAST(round(value * 10) AS BIGINT))) AS minutes FROM events""")
def duration_minutes(spark, sf_dir):
    seconds = F.round(F.col("value") * 10).cast("int")
    later = fn.add_interval("second", seconds, "ts")
    return t.event_rows(spark, sf_dir).select("event_id", "user_id",
                                              fn.minutes_between("ts", later).alias("minutes"))


@query("epoch_ms_to_ts", """SELECT event_id, epoch_ms(epoch_us(ts) // 1000) AS event_time,
    epoch_us(ts) // 1000 AS ms FROM events""")
def epoch_ms_to_ts(spark, sf_dir):
    return (t.event_rows(spark, sf_dir).select("event_id", fn.ts_to_epoch_ms("ts").alias("ms"))
            .withColumn("event_time", fn.epoch_ms_to_ts("ms")))


@query("parse_ts", """SELECT event_id, try_strptime(text, '%Y-%m-%d %H:%M:%S') AS event_time
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
             ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS text FROM events)""")
def parse_ts(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.event_rows(spark, sf_dir).select("event_id", fn.parse_ts(text).alias("event_time"))


@query("encode_base_id", """SELECT o_orderkey, base,
    CASE WHEN n % 7 = 0 THEN 's/' WHEN n % 3 = 0 THEN 'a/' ELSE 'e/' END || to_hex(n) AS base_id
FROM (SELECT o_orderkey, base, TRY_CAST(substr(base, 2) AS BIGINT) AS n FROM (
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Bx' ELSE 'B' END || lpad(
        CAST(o_custkey AS VARCHAR), CASE WHEN o_custkey % 2 = 0 THEN 5 ELSE 130 END, '0') AS base
    FROM orders))""")
def encode_base_id(spark, sf_dir):
    base = F.concat(F.when(F.col("o_orderstatus") == "P", "Bx").otherwise("B"),
                    F.when(F.col("o_custkey") % 2 == 0, F.lpad(F.col("o_custkey").cast("string"), 5, "0"))
                    .otherwise(F.lpad(F.col("o_custkey").cast("string"), 130, "0")))
    return (t.table(spark, sf_dir, "orders").select("o_orderkey", base.alias("base"))
            .withColumn("base_id", fn.encode_base_id("base")))


@query("map_vendor", """SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'Creative Mobile Technologies'
    WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM customer""")
def map_vendor(spark, sf_dir):
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey", fn.vendor_name("c_nationkey").alias("vendor_name"))


@query("safe_cast", """SELECT c_custkey, TRY_CAST(CASE WHEN c_nationkey = 3 THEN c_mktsegment
    ELSE CAST(c_nationkey AS VARCHAR) END AS BIGINT) AS number FROM customer""")
def safe_cast(spark, sf_dir):
    mixed = F.when(F.col("c_nationkey") == 3, F.col("c_mktsegment")).otherwise(
        F.col("c_nationkey").cast("string"))
    return t.table(spark, sf_dir, "customer").select("c_custkey", fn.safe_cast(mixed, "bigint").alias("number"))


# a third of the values missing, exact numbers
_GAPS = """(SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END AS a,
    CASE WHEN c_nationkey % 3 <> 1 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS b,
    CASE WHEN c_nationkey % 4 <> 2 THEN c_nationkey - 12 END AS c FROM customer)"""


def _gaps(spark, sf_dir):
    nation = F.col("c_nationkey")
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(nation % 3 != 0, nation).alias("a"),
        F.when(nation % 3 != 1, F.col("c_acctbal").cast("decimal(12,2)")).alias("b"),
        F.when(nation % 4 != 2, nation - 12).alias("c"))


@query("safe_add", f"""SELECT c_custkey,
    CAST(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS DECIMAL(16,2)) AS total FROM {_GAPS}""")
def safe_add(spark, sf_dir):
    return _gaps(spark, sf_dir).select("c_custkey",
                                       fn.safe_add(["a", "b", "c"]).cast("decimal(16,2)").alias("total"))


@query("safe_subtract", f"""SELECT c_custkey,
    CAST(coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS DECIMAL(16,2)) AS rest FROM {_GAPS}""")
def safe_subtract(spark, sf_dir):
    return _gaps(spark, sf_dir).select(
        "c_custkey", fn.safe_subtract(["a", "b", "c"]).cast("decimal(16,2)").alias("rest"))


@query("safe_divide", f"SELECT c_custkey, CAST(a AS DOUBLE) / nullif(c, 0) AS ratio FROM {_GAPS}")
def safe_divide(spark, sf_dir):
    return _gaps(spark, sf_dir).select("c_custkey", fn.safe_divide("a", "c").alias("ratio"))


@query("width_bucket", """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 100000 THEN 0
    WHEN o_totalprice >= 400000 THEN 7
    ELSE floor((o_totalprice - 100000) / 50000) + 1 END AS BIGINT) AS bucket FROM orders""")
def width_bucket(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.width_bucket("o_totalprice", 100000, 400000, 6).alias("bucket"))


def _haversine_sql(unit: str) -> str:
    factor = 2.0 * EARTH_RADIUS_MILES * PER_MILE[unit]
    return f"""SELECT event_id, round({factor!r} * asin(sqrt(
        pow(sin(radians(lat2 - lat1) / 2), 2)
        + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))), 6) AS distance
    FROM (SELECT event_id, user_id % 120 - 60.0 AS lat1, event_id % 350 - 175.0 AS lon1,
                 value % 60 AS lat2, user_id % 90 - 45.0 AS lon2 FROM events)"""


def _haversine(spark, sf_dir, unit):
    points = t.event_rows(spark, sf_dir).select(
        "event_id", (F.col("user_id") % 120 - 60.0).alias("lat1"),
        (F.col("event_id") % 350 - 175.0).alias("lon1"), (F.col("value") % 60).alias("lat2"),
        (F.col("user_id") % 90 - 45.0).alias("lon2"))
    return points.select("event_id", F.round(fn.haversine("lat1", "lon1", "lat2", "lon2", unit), 6)
                         .alias("distance"))


@query("haversine_mi", _haversine_sql("mi"))
def haversine_mi(spark, sf_dir):
    return _haversine(spark, sf_dir, "mi")


@query("haversine_km", _haversine_sql("km"))
def haversine_km(spark, sf_dir):
    return _haversine(spark, sf_dir, "km")


def _key_sql(null_text: str) -> str:
    def text(column: str) -> str:
        return f"coalesce(CAST({column} AS VARCHAR), '{null_text}')"

    return f"""SELECT o_orderkey, md5({text('o_custkey')} || '-' || {text('status')} || '-'
        || {text('o_orderdate')}) AS key
    FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)"""


def _keyed(spark, sf_dir, **options):
    orders = t.table(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return orders.select("o_orderkey", fn.surrogate_key(["o_custkey", "status", "o_orderdate"],
                                                        **options).alias("key"))


@query("surrogate_key", _key_sql(SURROGATE_KEY_NULL))
def surrogate_key(spark, sf_dir):
    return _keyed(spark, sf_dir)


@query("surrogate_key_empty", _key_sql(""))
def surrogate_key_empty(spark, sf_dir):
    return _keyed(spark, sf_dir, nulls_as_empty=True)


@query("row_fingerprint", f"""WITH {t.TRIPS_SQL}
SELECT pickup_datetime, md5(coalesce(CAST(vendor_id AS VARCHAR), '') || CAST(pickup_datetime AS VARCHAR)
    || CAST(dropoff_datetime AS VARCHAR) || CAST(pickup_location_id AS VARCHAR)
    || CAST(dropoff_location_id AS VARCHAR) || CAST(fare_amount AS VARCHAR)
    || CAST(trip_distance AS VARCHAR)) AS unique_row_id FROM trips""")
def row_fingerprint(spark, sf_dir):
    fields = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
              "dropoff_location_id", "fare_amount", "trip_distance"]
    return t.trips(spark, sf_dir, exact=True).select(
        "pickup_datetime", fn.row_fingerprint(fields, delimiter="").alias("unique_row_id"))


_BARE_URL = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("url_host", f"""SELECT page_id, split_part(split_part({_BARE_URL}, '/', 1), '?', 1) AS host
FROM pages""")
def url_host(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", fn.url_host("url").alias("host"))


# what stands between the first slash and the question mark; without a slash nothing if there is a
# query, else the whole text
@query("url_path", f"""SELECT page_id, CASE
    WHEN bare LIKE '%/%' THEN split_part(substr(bare, strpos(bare, '/') + 1), '?', 1)
    WHEN bare LIKE '%?%' THEN '' ELSE bare END AS path
FROM (SELECT page_id, {_BARE_URL} AS bare FROM pages)""")
def url_path(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", fn.url_path("url").alias("path"))


@query("url_param", """SELECT page_id,
    nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source,
    nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page FROM pages""")
def url_param(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select(
        "page_id", fn.url_parameter("url", "utm_source").alias("utm_source"),
        fn.url_parameter("url", "page").alias("page"))


@query("slugify", r"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(
    lower(p_size || ' ' || p_name || ' - ' || p_brand), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'),
    '^([0-9])', '_\1') AS slug FROM part""")
def slugify(spark, sf_dir):
    name = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit(" - "), "p_brand")
    return t.table(spark, sf_dir, "part").select("p_partkey", fn.slugify(name).alias("slug"))


@query("json_map_to_rows", """SELECT conv_id, 'turn:' || turn AS turn_key, turn, role, length(text) AS n_chars
FROM conversations""")
def map_to_rows(spark, sf_dir):
    # objects of at most 100 turns, so that a long conversation is not one row
    turns = t.table(spark, sf_dir, "conversations").withColumns({
        "block": F.floor(F.col("turn") / 100), "turn_key": F.concat(F.lit("turn:"), "turn")})
    objects = turns.groupBy("conv_id", "block").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct("turn_key", F.struct("turn", "role", F.length("text").alias("n_chars")))))).alias("doc"))
    return json_map_to_rows(objects, "doc", declared("turn bigint, role string, n_chars bigint"),
                            "turn_key", keep=["conv_id"])


@query("decode_events", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE event_type <> 'error'""")
def decode_events(spark, sf_dir):
    return decode_or_reject(_broken_events(spark, sf_dir), "props", declared("k int"))[0]


@query("decode_rejects", "SELECT event_id, left(props, 4) AS props FROM events WHERE event_type = 'error'")
def decode_rejects(spark, sf_dir):
    return decode_or_reject(_broken_events(spark, sf_dir), "props", declared("k int"))[1]


def _broken_events(spark, sf_dir):
    """Events whose error records carry cut-off JSON."""
    cut = F.when(F.col("event_type") == "error", F.left("props", F.lit(4))).otherwise(F.col("props"))
    return t.event_rows(spark, sf_dir).select("event_id", cut.alias("props"))


@query("encode_events", """SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id
    || ',"event_type":"' || event_type || '"}' AS record FROM events""")
def encode_events(spark, sf_dir):
    return t.event_rows(spark, sf_dir).select(
        "event_id", fn.encode_json("event_id", "user_id", "event_type").alias("record"))


@query("json_project_default", """SELECT event_id, json_extract_string(props, '$.k') AS k,
    'N/A' AS brand FROM events""")
def json_project_default(spark, sf_dir):
    return t.event_rows(spark, sf_dir).select("event_id", *fn.project_with_default("props", ["k", "brand"]))


def _distances(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("trip_distance"))


_SCORE_SQL = """SELECT l_orderkey, l_linenumber, l_quantity AS trip_distance,
    l_quantity * 5.0 AS predicted_duration FROM lineitem"""


@query("score_batches", _SCORE_SQL)
def score(spark, sf_dir):
    return score_batches(_distances(spark, sf_dir), linear_duration_model, ["trip_distance"])


@query("score_expr", _SCORE_SQL)
def score_expr(spark, sf_dir):
    return _distances(spark, sf_dir).withColumn("predicted_duration", score_expression("trip_distance"))
