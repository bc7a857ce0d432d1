"""Sources and sinks. Files the readers need are first written from the given tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ..functions import row_fingerprint
from ..operators import incremental
from ..operators.dedup import keep_first
from ..schemas import declared
from ..session import work_dir
from ..sources import audit, clustered, committed, json_arrays, readers, rejects, writers
from . import _tables as t
from ._registry import query

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
_ORDER_SCHEMA = declared("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                         "o_orderdate timestamp")
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders"


def _orders(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)


def _orders_csv(spark, sf_dir, label, **options) -> str:
    path = work_dir(spark, label)
    (_orders(spark, sf_dir).write.option("header", True)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").options(**options).csv(path))
    return path


@query("scan_csv_header", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(o_orderdate AS VARCHAR) AS o_orderdate
FROM orders""")
def scan_csv_header(spark, sf_dir):
    return readers.read_csv_strings(spark, _orders_csv(spark, sf_dir, "csv"))


@query("scan_csv_schema", _ORDERS_SQL)
def scan_csv_schema(spark, sf_dir):
    path = _orders_csv(spark, sf_dir, "csv-gz", compression="gzip")
    return readers.read_csv(spark, path, _ORDER_SCHEMA)


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet", t.SCHEMAS["orders"])


@query("scan_parquet_recursive", _ORDERS_SQL)
def scan_parquet_recursive(spark, sf_dir):
    path = work_dir(spark, "tree")
    for status in ["F", "O", "P"]:
        writers.convert_to_parquet(_orders(spark, sf_dir).where(F.col("o_orderstatus") == status),
                                   f"{path}/any/{status}/depth")
    return readers.read_parquet(spark, path, _ORDER_SCHEMA, recursive=True)


@query("scan_glob", _ORDERS_SQL)
def scan_glob(spark, sf_dir):
    path = work_dir(spark, "glob")
    writers.convert_to_parquet(_orders(spark, sf_dir), path, files=4)
    return readers.read_parquet(spark, f"{path}/part-*.parquet", _ORDER_SCHEMA)


@query("external_table", _ORDERS_SQL + " WHERE o_orderstatus = 'F'")
def external_table(spark, sf_dir):
    path = _orders_csv(spark, sf_dir, "external")
    name = f"orders_external_{uuid.uuid4().hex}"
    readers.external_table(spark, name, path, _ORDER_SCHEMA, "csv", {
        "header": "true", "timestampFormat": "yyyy-MM-dd HH:mm:ss"})
    return spark.sql(f"SELECT * FROM {name} WHERE o_orderstatus = 'F'")


@query("json_records", """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
    CASE WHEN event_type = 'view' THEN 'N/A' ELSE CAST(user_id AS VARCHAR) END AS user_id FROM events""")
def json_records(spark, sf_dir):
    path = work_dir(spark, "json")
    # NULL fields are not written, so views lack the key
    (t.event_rows(spark, sf_dir).select("event_id", "event_type", F.when(
        F.col("event_type") != "view", F.col("user_id")).alias("user_id")).write.json(path))
    return readers.read_json_records(spark, path, ["event_id", "event_type", "user_id"])


@query("json_array_records", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def json_array_records(spark, sf_dir):
    """All orders as few files of one array each, under a key, cut into records by many tasks."""
    path = work_dir(spark, "array")
    order = F.struct("o_orderkey", "o_orderstatus", "o_totalprice", F.lit('} "orders": [{').alias("note"))
    lists = (t.table(spark, sf_dir, "orders").groupBy(F.expr("o_orderkey % 4").alias("part"))
             .agg(F.collect_list(order).alias("orders")))
    lists.select(F.to_json(F.struct("part", "orders")).alias("value")).write.text(path)
    return json_arrays.read_json_array(
        spark, path, declared("o_orderkey bigint, o_orderstatus string, o_totalprice double"), "orders")


@query("json_pages_to_rows", "SELECT conv_id, turn, role, text FROM conversations")
def json_pages_to_rows(spark, sf_dir):
    path = work_dir(spark, "pages")
    turns = t.table(spark, sf_dir, "conversations")
    # one page holds at most 100 records, as the paged source would send them
    pages = (turns.withColumn("page_number", F.floor(F.col("turn") / 100).cast("bigint"))
             .groupBy("conv_id", "page_number")
             .agg(F.collect_list(F.struct("turn", "role", "text")).alias("docs")))
    pages.write.json(path)
    return readers.read_pages(spark, path, declared("turn bigint, role string, text string"), "docs",
                              declared("conv_id bigint"))


@query("convert_to_parquet", _ORDERS_SQL)
def convert_to_parquet(spark, sf_dir):
    source = readers.read_csv(spark, _orders_csv(spark, sf_dir, "csv-gz", compression="gzip"), _ORDER_SCHEMA)
    path = work_dir(spark, "converted")
    writers.convert_to_parquet(source, path, files=4)
    return readers.read_parquet(spark, path, _ORDER_SCHEMA)


@query("write_if_absent", _ORDERS_SQL)
def write_if_absent(spark, sf_dir):
    path = work_dir(spark, "once")
    writers.write_if_absent(_orders(spark, sf_dir), path)
    # the target is complete now, so this second write must change nothing
    writers.write_if_absent(_orders(spark, sf_dir).where("o_orderstatus = 'F'"), path)
    return readers.read_parquet(spark, path, _ORDER_SCHEMA)


@query("append_table", _ORDERS_SQL)
def append_table(spark, sf_dir):
    path = work_dir(spark, "append")
    orders = _orders(spark, sf_dir)
    writers.create_empty(orders, path)
    for status in ["F", "O", "P"]:
        writers.append_rows(orders.where(F.col("o_orderstatus") == status), path)
    return readers.read_parquet(spark, path, _ORDER_SCHEMA)


@query("write_single_file", "SELECT o_orderstatus, count(*) AS n_orders, CAST(1 AS BIGINT) AS n_files "
                            "FROM orders GROUP BY o_orderstatus")
def write_single_file(spark, sf_dir):
    path = work_dir(spark, "single")
    writers.write_single_file(_orders(spark, sf_dir).groupBy("o_orderstatus")
                              .agg(F.count("*").alias("n_orders")), path)
    files = audit.storage_audit(spark, {"report": path}, "*.parquet").select("n_files").scalar()
    return readers.read_parquet(spark, path).withColumn("n_files", files)


@query("write_table", "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def write_table(spark, sf_dir):
    path = work_dir(spark, "warehouse")
    report = _orders(spark, sf_dir).groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))
    for _ in range(2):  # a second run replaces the first
        writers.write_table(report, path, "orc", options={"compression": "zlib"})
    return spark.read.orc(path)


@query("ctas", _ORDERS_SQL)
def ctas(spark, sf_dir):
    path = work_dir(spark, "ctas")
    return writers.create_table_as(_orders(spark, sf_dir), f"orders_{uuid.uuid4().hex}", path=path)


def _lines_by_day(spark, sf_dir) -> str:
    path = work_dir(spark, "by-day")
    lines = t.table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_orderkey")
    # one folder per day of the last part of the data would be thousands of files here, so the
    # stand-in timestamp folds the dates into one quarter
    folded = F.timestamp_add("DAY", (F.datediff("l_shipdate", F.lit("1995-01-01")) % 90).cast("int"),
                             F.lit("2024-02-01").cast("timestamp"))
    writers.write_by_day(lines.withColumn("dropoff_datetime", folded), path, "dropoff_datetime",
                         cluster_by=["l_suppkey"])
    return path


@query("partitioned_table", """SELECT DISTINCT l_suppkey FROM lineitem
WHERE DATE '2024-02-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 90
      AS INTEGER) BETWEEN DATE '2024-03-01' AND DATE '2024-03-15'""")
def partitioned_table(spark, sf_dir):
    path = _lines_by_day(spark, sf_dir)
    rows = readers.read_days(spark, path, "dropoff_datetime", date(2024, 3, 1), date(2024, 3, 16))
    return rows.select("l_suppkey").distinct()


def _storage(spark, sf_dir):
    csv = work_dir(spark, "csv-gz")
    _orders(spark, sf_dir).repartition(3).write.option("compression", "gzip").csv(csv)
    parquet = work_dir(spark, "parquet")
    writers.convert_to_parquet(_orders(spark, sf_dir), parquet, files=4)
    return audit.storage_audit(spark, {"csv": csv, "parquet": parquet}, "part-*")


@query("store_round_trip", """SELECT o_orderkey, o_orderstatus, CAST(1 AS INTEGER) AS version FROM orders""")
def store_round_trip(spark, sf_dir):
    """A committed table on a store that is known by name only: written, merged, compacted and read."""
    root = writers.mount(spark, f"lake{uuid.uuid4().hex}", work_dir(spark, "store")) + "/orders"
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    wrong = orders.where("o_orderkey % 2 = 0").withColumn("version", F.lit(0))
    incremental.merge_partitions(spark, wrong, root, "o_orderkey", "o_orderstatus")
    incremental.merge_partitions(spark, orders.withColumn("version", F.lit(1)), root, "o_orderkey", "o_orderstatus")
    incremental.compact_partitions(spark, root, most_loads=0)
    return committed.read_committed(spark, root)


@query("storage_audit")
def storage_audit(spark, sf_dir):
    return _storage(spark, sf_dir)


@query("storage_file_counts", "SELECT 'csv' AS tree, CAST(3 AS BIGINT) AS n_files, count(*) > 0 AS has_bytes "
                              "FROM orders UNION ALL SELECT 'parquet', 4, count(*) > 0 FROM orders")
def storage_file_counts(spark, sf_dir):
    """What the audit says that does not hang on the writer's version."""
    return _storage(spark, sf_dir).select("tree", "n_files", (F.col("total_bytes") > 0).alias("has_bytes"))


@query("text_line_count", "SELECT count(*) AS n_lines FROM orders")
def text_line_count(spark, sf_dir):
    path = work_dir(spark, "text-gz")
    (_orders(spark, sf_dir).select(F.col("o_orderkey").cast("string")).write
     .option("compression", "gzip").text(path))
    return audit.line_count(spark, path)


@query("seed_lookup", f"""WITH {t.PAYMENT_SQL}
SELECT o_orderkey, description FROM orders JOIN payments ON o_custkey % 7 = payment_type""")
def seed_lookup(spark, sf_dir):
    payments = t.payment_types(spark)
    orders = _orders(spark, sf_dir).withColumn("code", (F.col("o_custkey") % 7).cast("int"))
    return (orders.join(payments, F.col("code") == F.col("payment_type"))
            .select("o_orderkey", "description"))


@query("load_with_lineage", """SELECT md5(CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR))
    AS unique_row_id, o_orderkey, true AS has_file FROM orders""")
def load_with_lineage(spark, sf_dir):
    source = readers.read_csv(spark, _orders_csv(spark, sf_dir, "csv"), _ORDER_SCHEMA)
    loaded = readers.with_lineage(source, row_fingerprint(["o_orderkey", "o_custkey"]))
    return loaded.select("unique_row_id", "o_orderkey",
                         F.col("filename").startswith("part-").alias("has_file"))


@query("seed_csv", """SELECT c_custkey, n_name, n_regionkey FROM customer
JOIN nation ON c_nationkey = n_nationkey""")
def seed_csv(spark, sf_dir):
    """A lookup kept as a CSV file with typed columns."""
    path = work_dir(spark, "seed")
    t.table(spark, sf_dir, "nation").coalesce(1).write.option("header", True).csv(path)
    nations = readers.read_seed(spark, path, t.SCHEMAS["nation"])
    customers = t.table(spark, sf_dir, "customer")
    return (customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "n_name", "n_regionkey"))


@query("write_table_if_absent", _ORDERS_SQL)
def write_table_if_absent(spark, sf_dir):
    name = f"orders_{uuid.uuid4().hex}"
    writers.create_table_if_absent(_orders(spark, sf_dir), name)
    # the table is there now, so this second write must change nothing
    writers.create_table_if_absent(_orders(spark, sf_dir).where("o_orderstatus = 'F'"), name)
    return spark.table(name)


# --- tables clustered by key ---

def _clustered(spark, sf_dir, table, keys, columns):
    name, path = f"{table}_{uuid.uuid4().hex}", work_dir(spark, "clustered")
    clustered.write_clustered(t.table(spark, sf_dir, table).select(*columns), name, keys, 16, path)
    return clustered.read_clustered(spark, name)


@query("clustered_join", """SELECT o_orderkey, o_orderstatus, count(*) AS n_lines, max(l_linenumber) AS last_line
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def clustered_join(spark, sf_dir):
    """Two tables clustered by the order: joined and grouped bucket by bucket, without a shuffle."""
    orders = _clustered(spark, sf_dir, "orders", ["o_orderkey"], ["o_orderkey", "o_orderstatus"])
    lines = _clustered(spark, sf_dir, "lineitem", ["l_orderkey"], ["l_orderkey", "l_linenumber"])
    return (orders.hint("merge").join(lines, orders.o_orderkey == lines.l_orderkey)
            .groupBy("o_orderkey", "o_orderstatus")
            .agg(F.count("*").alias("n_lines"), F.max("l_linenumber").alias("last_line")))


@query("clustered_keep_first", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey) = 1""")
def clustered_keep_first(spark, sf_dir):
    """One row per cluster key, found inside each bucket."""
    lines = _clustered(spark, sf_dir, "lineitem", ["l_orderkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return keep_first(lines, ["l_orderkey"], [F.desc("l_linenumber"), "l_partkey", "l_suppkey"]).drop("l_suppkey")


# --- CSV loads that keep what they cannot read ---

_PRICED = declared("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp")
_LINES_SQL = """lines AS (SELECT *, o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0 AS bad,
    concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
              CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END,
              CASE WHEN o_orderkey % 89 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
              CASE WHEN o_orderkey % 83 = 0 THEN 'more' END) AS line FROM orders)"""


def _csv_load(spark, sf_dir) -> rejects.Load:
    """Orders as CSV; some lines have text for a number, some a field too few or too many."""
    key = F.col("o_orderkey")
    price = F.when(key % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    fields = [key.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), price,
              F.when(key % 89 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), F.when(key % 83 == 0, "more")]
    source = work_dir(spark, "lines")
    t.table(spark, sf_dir, "orders").select(F.concat_ws(",", *fields).alias("value")).write.text(source)
    return rejects.load_csv(spark, source, _PRICED, work_dir(spark, "loaded"), header=False)


@query("csv_loaded", f"WITH {_LINES_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM lines WHERE NOT bad")
def csv_loaded(spark, sf_dir):
    return _csv_load(spark, sf_dir).rows().drop("filename")


@query("csv_rejects", f"WITH {_LINES_SQL} SELECT line FROM lines WHERE bad")
def csv_rejects(spark, sf_dir):
    return _csv_load(spark, sf_dir).rejects().select("line")


@query("csv_load_audit", f"""WITH {_LINES_SQL} SELECT CAST(count(*) FILTER (NOT bad) AS BIGINT) AS n_loaded,
    CAST(count(*) FILTER (bad) AS BIGINT) AS n_rejected FROM lines""")
def csv_load_audit(spark, sf_dir):
    return _csv_load(spark, sf_dir).audit().agg(F.sum("n_loaded").alias("n_loaded"), F.sum("n_rejected").alias("n_rejected"))
