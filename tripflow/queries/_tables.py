"""The given tables and the trip feeds derived from them, in Spark and as SQL text.

The given tables are a trade schema; one line item stands for one trip. Values are scaled so that
every rule of the staging filter both keeps and drops rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import row_fingerprint
from ..plans import jobs, staging
from ..schemas import MONEY_COLUMNS, PAYMENT_TYPE_ROWS, PAYMENT_TYPES, declared
from ..sources.readers import read_parquet, seed

# Declared, so that timestamps are read as moments (session zone UTC) and no footer pass is needed.
SCHEMAS = {name: declared(ddl) for name, ddl in {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
              "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}.items()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def payment_types(spark: SparkSession) -> DataFrame:
    return seed(spark, PAYMENT_TYPE_ROWS, PAYMENT_TYPES)


PAYMENT_SQL = "payments(payment_type, description) AS (VALUES {})".format(
    ", ".join(f"({code}, '{text}')" for code, text in PAYMENT_TYPE_ROWS))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the layout of the seed: nations of the first four regions as zones, so that
    some trips have no known zone."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .where("r_regionkey > 0")
            .select(F.col("n_nationkey").alias("locationid"), F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone"),
                    F.when(F.col("n_nationkey") % 2 == 0, "Boro Zone").otherwise("Yellow Zone")
                    .alias("service_zone")))


ZONES_SQL = """zones AS (
    SELECT n_nationkey AS locationid, r_name AS borough, n_name AS zone,
           CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey > 0)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the pickup and dropoff nation and the order's date and price.

    Orders meet customers first: that is the smaller shuffle, and line items then join one table
    by order key.
    """
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("dropoff_nation"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey"), F.col("s_nationkey").alias("pickup_nation"))
    order_ends = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (table(spark, sf_dir, "lineitem")
            .join(order_ends, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))


LINES_SQL = """lines AS (
    SELECT l.*, o.*, c.c_nationkey AS dropoff_nation, s.s_nationkey AS pickup_nation
    FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
    JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey)"""


def _exact(expression: Column, scale: int = 4) -> Column:
    return expression.cast(f"decimal(18,{scale})")


# --- trip feeds: Spark ---

def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as loaded: identifiers and codes as text, amounts as doubles of at most four
    decimals, without the noise of a product."""
    c = F.col
    line = c("l_linenumber")
    file_date = F.date_add("o_orderdate", F.when(line == 7, 3).otherwise(0))
    feed = F.when(c("l_linestatus") == "O", "green").otherwise("yellow")
    mta_tax = F.when(c("l_discount") > 0.095, 0.8).when(c("l_discount") < 0.045, 0.5).otherwise(0.0)
    columns = {
        "l_linestatus": c("l_linestatus"),
        "filename": F.concat(feed, F.lit("_tripdata_"), F.date_format(file_date, "yyyy-MM"),
                             F.lit(".csv.gz")),
        # 0 stands for a missing vendor
        "VendorID": F.nullif(c("l_suppkey") % 5, F.lit(0)).cast("string"),
        "pickup_datetime": _later("o_orderdate", (line - 1) * 3600),
        "dropoff_datetime": _later("l_shipdate", c("l_partkey") % 1440 * 60 + 30),
        "store_and_fwd_flag": F.when(c("l_returnflag") == "R", "Y").otherwise("N"),
        "RatecodeID": F.when(c("l_partkey") % 50 == 0, "n/a").otherwise(
            (c("l_partkey") % 7 + 1).cast("string")),
        "PULocationID": c("pickup_nation").cast("string"),
        "DOLocationID": c("dropoff_nation").cast("string"),
        "passenger_count": line,
        "trip_distance": F.round(c("l_quantity") * 2.1, 4),
        "fare_amount": c("l_extendedprice"),
        "extra": F.round(c("l_tax") * 50, 4),
        "mta_tax": mta_tax,
        "tip_amount": F.round(c("l_discount") * 100, 4),
        "tolls_amount": (c("l_partkey") % 4).cast("double"),
        "improvement_surcharge": F.lit(0.3),
        "total_amount": F.floor("o_totalprice") / 1000,
        "payment_type": ((c("l_orderkey") + line) % 7).cast("string"),
        "congestion_surcharge": F.when(line > 3, 2.5).otherwise(0.0),
        "trip_type": (c("l_orderkey") % 2 + 1).cast("string"),
    }
    rows = lines(spark, sf_dir).select(*[value.alias(name) for name, value in columns.items()])
    return rows.withColumn("unique_row_id", row_fingerprint(FINGERPRINT_FIELDS))


FINGERPRINT_FIELDS = ["VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]


def _later(ts: str, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(F.col(ts)) + seconds)


def raw_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_raw(spark, sf_dir).where("l_linestatus = 'O'").drop("l_linestatus")
            .withColumnsRenamed({"pickup_datetime": "lpep_pickup_datetime",
                                 "dropoff_datetime": "lpep_dropoff_datetime"}))


def raw_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_raw(spark, sf_dir).where("l_linestatus = 'F'").drop("l_linestatus", "trip_type")
            .withColumnsRenamed({"pickup_datetime": "tpep_pickup_datetime",
                                 "dropoff_datetime": "tpep_dropoff_datetime"}))


def trips(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """Both feeds under common names, unfiltered, from one scan; amounts as loaded or exact."""
    service = F.when(F.col("l_linestatus") == "O", "Green").otherwise("Yellow")
    amounts = [F.col(c).cast("decimal(18,4)" if exact else "double").alias(c)
               for c in ["trip_distance", *MONEY_COLUMNS]]
    return _raw(spark, sf_dir).select(
        service.alias("service_type"), F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        "pickup_datetime", "dropoff_datetime", "passenger_count",
        F.col("payment_type").cast("int").alias("payment_type"), *amounts)


# --- trip feeds: SQL ---

RAW_SQL = LINES_SQL + """,
raw_rows AS (
    SELECT l_linestatus,
           CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END || '_tripdata_'
               || strftime(CASE WHEN l_linenumber = 7 THEN o_orderdate + INTERVAL 3 DAY
                           ELSE o_orderdate END, '%Y-%m') || '.csv.gz' AS filename,
           CAST(nullif(l_suppkey % 5, 0) AS VARCHAR) AS VendorID,
           o_orderdate + to_hours(l_linenumber - 1) AS pickup_datetime,
           l_shipdate + to_minutes(l_partkey % 1440) + INTERVAL 30 SECOND AS dropoff_datetime,
           CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
           CASE WHEN l_partkey % 50 = 0 THEN 'n/a' ELSE CAST(l_partkey % 7 + 1 AS VARCHAR) END
               AS RatecodeID,
           CAST(pickup_nation AS VARCHAR) AS PULocationID,
           CAST(dropoff_nation AS VARCHAR) AS DOLocationID,
           l_linenumber AS passenger_count,
           CAST(CAST(l_quantity AS DECIMAL(10,2)) * 2.1 AS DECIMAL(18,4)) AS trip_distance,
           CAST(l_extendedprice AS DECIMAL(18,4)) AS fare_amount,
           CAST(CAST(l_tax AS DECIMAL(4,2)) * 50 AS DECIMAL(18,4)) AS extra,
           CAST(CASE WHEN l_discount > 0.095 THEN 0.8 WHEN l_discount < 0.045 THEN 0.5 ELSE 0.0 END
               AS DECIMAL(18,4)) AS mta_tax,
           CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(18,4)) AS tip_amount,
           CAST(l_partkey % 4 AS DECIMAL(18,4)) AS tolls_amount,
           CAST(0.3 AS DECIMAL(18,4)) AS improvement_surcharge,
           CAST(floor(o_totalprice) / 1000 AS DECIMAL(18,4)) AS total_amount,
           CAST((l_orderkey + l_linenumber) % 7 AS VARCHAR) AS payment_type,
           CAST(CASE WHEN l_linenumber > 3 THEN 2.5 ELSE 0.0 END AS DECIMAL(18,4))
               AS congestion_surcharge,
           CAST(l_orderkey % 2 + 1 AS VARCHAR) AS trip_type
    FROM lines),
raw_all AS (
    SELECT *, md5(concat_ws('-', coalesce(VendorID, ''), CAST(pickup_datetime AS VARCHAR),
                  CAST(dropoff_datetime AS VARCHAR), PULocationID, DOLocationID)) AS unique_row_id
    FROM raw_rows)"""

RAW_GREEN_SQL = """raw_green AS (
    SELECT * EXCLUDE (l_linestatus) RENAME (pickup_datetime AS lpep_pickup_datetime,
                                            dropoff_datetime AS lpep_dropoff_datetime)
    FROM raw_all WHERE l_linestatus = 'O')"""
RAW_YELLOW_SQL = """raw_yellow AS (
    SELECT * EXCLUDE (l_linestatus, trip_type) RENAME (pickup_datetime AS tpep_pickup_datetime,
                                                       dropoff_datetime AS tpep_dropoff_datetime)
    FROM raw_all WHERE l_linestatus = 'F')"""

TRIPS_SQL = RAW_SQL + """,
trips AS (
    SELECT CASE WHEN l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service_type,
           CAST(VendorID AS INTEGER) AS vendor_id,
           CAST(PULocationID AS INTEGER) AS pickup_location_id,
           CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
           pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
           CAST(payment_type AS INTEGER) AS payment_type,
           fare_amount, extra, mta_tax, tip_amount, tolls_amount, congestion_surcharge,
           improvement_surcharge, total_amount
    FROM raw_all)"""


def _staged(name: str) -> str:
    return f"CAST({name} AS DECIMAL(18,9)) AS {name}"


# fixed values: the accepted ranges and codes are those of `plans/staging.py`
def _staged_sql(feed: str, prefix: str, max_distance: int) -> str:
    trip_type = "TRY_CAST(trip_type AS BIGINT) AS trip_type," if feed == "green" else ""
    return f"""stg_{feed} AS (
    SELECT unique_row_id, filename AS file_name, CAST(VendorID AS INTEGER) AS vendor_id,
           TRY_CAST(RatecodeID AS BIGINT) AS rate_code_id,
           TRY_CAST(PULocationID AS BIGINT) AS pickup_location_id,
           TRY_CAST(DOLocationID AS BIGINT) AS dropoff_location_id,
           {prefix}_pickup_datetime AS pickup_datetime, {prefix}_dropoff_datetime AS dropoff_datetime,
           store_and_fwd_flag, passenger_count, {_staged('trip_distance')}, {trip_type}
           {', '.join(map(_staged, ['fare_amount', 'extra', 'mta_tax', 'tip_amount', 'tolls_amount',
                                    'improvement_surcharge', 'total_amount', 'congestion_surcharge']))},
           TRY_CAST(payment_type AS BIGINT) AS payment_type
    FROM raw_{feed} WHERE VendorID IS NOT NULL),
kept_{feed} AS (
    SELECT * FROM stg_{feed}
    WHERE passenger_count BETWEEN 0 AND 6 AND trip_distance BETWEEN 0 AND {max_distance}
      AND dropoff_datetime > pickup_datetime
      AND pickup_location_id BETWEEN 1 AND 265 AND dropoff_location_id BETWEEN 1 AND 265
      AND total_amount BETWEEN 2.50 AND 500 AND fare_amount > 0
      AND payment_type IN (1, 2, 3, 4, 6) AND rate_code_id <= 6 AND mta_tax IN (0, 0.5)
      AND extra IN (0, 0.5, 1.0, 2.5, 3.0, 3.5)
      AND strftime(pickup_datetime, '%Y-%m') = regexp_extract(file_name, '[0-9]{{4}}-[0-9]{{2}}'))"""


STAGED_SQL = ",\n".join([RAW_SQL, RAW_GREEN_SQL, RAW_YELLOW_SQL,
                         _staged_sql("green", "lpep", 50), _staged_sql("yellow", "tpep", 100)])

UNIONED_SQL = STAGED_SQL + """,
unioned AS (
    SELECT * EXCLUDE (unique_row_id, file_name), 'Green' AS service_type FROM kept_green
    UNION ALL BY NAME
    SELECT * EXCLUDE (unique_row_id, file_name), CAST(1 AS BIGINT) AS trip_type,
           'Yellow' AS service_type FROM kept_yellow)"""

_KEY = "vendor_id, pickup_datetime, pickup_location_id, service_type"
UNIQUE_SQL = UNIONED_SQL + f""",
{PAYMENT_SQL},
unique_trips AS (
    SELECT u.* REPLACE (coalesce(u.payment_type, 0) AS payment_type),
           md5(concat_ws('-', CAST(vendor_id AS VARCHAR), CAST(pickup_datetime AS VARCHAR),
                         CAST(pickup_location_id AS VARCHAR), service_type)) AS trip_id,
           coalesce(p.description, 'Unknown') AS payment_type_description
    FROM (SELECT * FROM unioned QUALIFY row_number() OVER (
              PARTITION BY {_KEY} ORDER BY dropoff_datetime, dropoff_location_id, total_amount,
              trip_distance, fare_amount, passenger_count, tip_amount, extra, mta_tax,
              rate_code_id, payment_type, tolls_amount, store_and_fwd_flag) = 1) u
    LEFT JOIN payments p ON coalesce(u.payment_type, 0) = p.payment_type)"""

FACT_SQL = UNIQUE_SQL + f""",
{ZONES_SQL},
fct AS (
    SELECT trip_id, vendor_id, service_type, rate_code_id, pickup_location_id,
           pz.borough AS pickup_borough, pz.zone AS pickup_zone, dropoff_location_id,
           dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, pickup_datetime,
           dropoff_datetime, store_and_fwd_flag, passenger_count, trip_distance, trip_type,
           date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
           fare_amount, extra, mta_tax, tip_amount, tolls_amount, congestion_surcharge,
           improvement_surcharge, total_amount, payment_type, payment_type_description
    FROM unique_trips t LEFT JOIN zones pz ON t.pickup_location_id = pz.locationid
    LEFT JOIN zones dz ON t.dropoff_location_id = dz.locationid)"""


# --- model layers on the derived feeds ---

def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (staging.stage_feed(raw_green(spark, sf_dir), staging.GREEN),
            staging.stage_feed(raw_yellow(spark, sf_dir), staging.YELLOW))


def unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.union_services(*staged(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.build_fact(raw_green(spark, sf_dir), raw_yellow(spark, sf_dir),
                           payment_types(spark), zones(spark, sf_dir))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def to_cents(value: Column | str) -> Column:
    """Exact cents of a double, so that sums do not depend on row order."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")
