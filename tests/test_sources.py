from __future__ import annotations

import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set, rows_of
from tripflow.operators import incremental
from tripflow.plans import jobs
from tripflow.schemas import declared
from tripflow.session import work_dir, work_root
from tripflow.sources import audit, catalog, committed, readers, writers

SCHEMA = declared("id int, at timestamp, amount double")
TEXT = "id,at,amount\n1,2024-01-01 10:00:00,2.5\n2,2024-01-02 11:30:00,\n"


def test_csv(spark, tmp_path):
    with gzip.open(tmp_path / "trips_2024-01.csv.gz", "wt") as file:
        file.write(TEXT)
    path = str(tmp_path)
    assert row_set(readers.read_csv_strings(spark, path)) == {
        ("1", "2024-01-01 10:00:00", "2.5"), ("2", "2024-01-02 11:30:00", None)}
    rows = readers.read_csv(spark, path, SCHEMA)
    assert row_set(rows) == {(1, datetime(2024, 1, 1, 10), 2.5), (2, datetime(2024, 1, 2, 11, 30), None)}
    assert rows_of(audit.line_count(spark, path)) == [(3,)]
    lineage = readers.with_lineage(rows, F.md5(F.col("id").cast("string")))
    assert lineage.columns == ["unique_row_id", "filename", "id", "at", "amount"]
    assert {r.filename for r in lineage.collect()} == {"trips_2024-01.csv.gz"}


def test_csv_ignores_trailing_values(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("id,at,amount,more\n1,2024-01-01 10:00:00,2.5,x\n")
    assert row_set(readers.read_csv(spark, str(tmp_path), SCHEMA)) == {(1, datetime(2024, 1, 1, 10), 2.5)}


def test_json_records_and_pages(spark, tmp_path):
    (tmp_path / "products.json").write_text(
        '{"products": [{"title": "a", "brand": "b", "price": 1.5}, {"title": "c", "price": 2}]}')
    rows = readers.read_json_records(spark, str(tmp_path), ["title", "brand", "price"], "products")
    assert row_set(rows) == {("a", "b", "1.5"), ("c", "N/A", "2")}
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p1.json").write_text('{"numFound": 3, "docs": [{"t": "x"}, {"t": "y"}]}\n')
    (pages / "p2.json").write_text('{"numFound": 3, "docs": [{"t": "z"}]}\n{"numFound": 3, "docs": []}\n')
    paged = readers.read_pages(spark, str(pages), declared("t string"), "docs", declared("numFound int"))
    assert row_set(paged) == {(3, "x"), (3, "y"), (3, "z")}


def test_write_if_absent(spark, frame, tmp_path):
    path = str(tmp_path / "out")
    assert writers.write_if_absent(frame("x int", [(1,)]), path, files=1)
    assert not writers.write_if_absent(frame("x int", [(2,)]), path)
    assert rows_of(spark.read.parquet(path)) == [(1,)]
    # output without its marker counts as absent and is replaced
    (tmp_path / "out" / "_SUCCESS").unlink()
    assert writers.write_if_absent(frame("x int", [(3,)]), path)
    assert rows_of(spark.read.parquet(path)) == [(3,)]


def test_append_and_create_empty(spark, frame, tmp_path):
    path = str(tmp_path / "table")
    writers.append_rows(frame("x int", [(9,)]), path)
    writers.create_empty(frame("x int", [(1,)]), path)
    writers.append_rows(frame("x int", [(1,), (2,)]), path)
    writers.append_rows(frame("x int", [(2,)]), path)
    assert sorted(rows_of(spark.read.parquet(path))) == [(1,), (2,), (2,)]


def test_storage_audit(spark, frame, tmp_path):
    df = spark.range(1000).withColumn("text", F.lit("some text that repeats"))
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "pq")
    df.write.csv(csv)
    writers.convert_to_parquet(df, parquet, files=4)
    report = {r.tree: r for r in audit.storage_audit(spark, {"csv": csv, "parquet": parquet}, "part-*").collect()}
    assert report["parquet"].n_files == 4
    assert report["csv"].ratio_to_first == 1.0
    assert report["parquet"].ratio_to_first == report["parquet"].total_bytes / report["csv"].total_bytes
    size = sum(f.stat().st_size for f in (tmp_path / "pq").glob("part-*"))
    assert report["parquet"].total_bytes == size and report["parquet"].mean_bytes == size / 4


def test_by_day_prunes(spark, frame, tmp_path):
    path = str(tmp_path / "days")
    rows = [(i, datetime(2024, 3, 1 + i % 20, 12)) for i in range(200)]
    writers.write_by_day(frame("id int, at timestamp", rows), path, "at", cluster_by=["id"])
    kept = readers.read_days(spark, path, "at", date(2024, 3, 3), date(2024, 3, 5))
    assert {r.at.day for r in kept.collect()} == {3, 4}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(at)" in plan
    assert len({f.split("/day=")[1][:10] for f in kept.inputFiles() if "/day=" in f}) >= 2
    scanned = kept.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("/day=")[1][:10] for r in scanned} == {"2024-03-03", "2024-03-04"}


def test_by_month_replaces_only_its_months(spark, frame, tmp_path):
    path = str(tmp_path / "months")
    first = [(datetime(2020, 1, 5), "Green", 1), (datetime(2020, 2, 5), "Green", 2), (datetime(2020, 1, 6), "Yellow", 3)]
    schema = "at timestamp, kind string, n int"
    writers.write_by_month(frame(schema, first), path, "at", "kind")
    writers.write_by_month(frame(schema, [(datetime(2020, 1, 7), "Green", 9)]), path, "at", "kind")
    stored = {(r.service, r.year, r.month, r.n) for r in spark.read.parquet(path).collect()}
    assert stored == {("green", 2020, 1, 9), ("green", 2020, 2, 2), ("yellow", 2020, 1, 3)}


def test_seed(spark):
    df = readers.seed(spark, [(1, "a"), (2, None)], declared("k int, v string"))
    assert df.dtypes == [("k", "int"), ("v", "string")] and row_set(df) == {(1, "a"), (2, None)}
    with pytest.raises(ValueError):
        readers.seed(spark, [(i, "x") for i in range(readers.MAX_INLINE_SEED + 1)], declared("k int, v string"))


def test_external_table_and_ctas(spark, frame, tmp_path):
    frame("x int", [(1,), (2,)]).write.csv(str(tmp_path / "ext"))
    readers.external_table(spark, "ext_view", str(tmp_path / "ext"), declared("x int"), "csv")
    made = writers.create_table_as(spark.sql("SELECT x + 1 AS y FROM ext_view"), "made_table",
                                   path=str(tmp_path / "made"))
    assert row_set(made) == {(2,), (3,)}
    spark.sql("DROP TABLE made_table")


def test_work_root_comes_from_the_session(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(work_root(spark))
    assert work_dir(spark, "x") != work_dir(spark, "x")


# --- incremental ---

def test_insert_new_knows_rows_without_a_time(frame):
    rows = frame("k string, at timestamp", [("a", None), ("b", datetime(2024, 1, 1))])
    assert rows_of(incremental.insert_new(rows, rows, "k", within="at")) == []


def test_relations_of_other_databases(spark, tmp_path):
    for place in ("yard_one", "yard_two"):
        spark.sql(f"CREATE DATABASE {place}")
        spark.range(2).withColumn("place", F.lit(place)).write.saveAsTable(f"{place}.cabs")
    spark.range(1).createOrReplaceTempView("cabs_view")
    try:
        found = catalog.relations_by_pattern(spark, "cab%", database="yard%")
        assert {k: v.first().place for k, v in found.items()} == {
            "yard_one.cabs": "yard_one", "yard_two.cabs": "yard_two"}
        assert list(catalog.relations_by_prefix(spark, "CABS")) == ["cabs_view"]
        none = spark.range(0)
        assert catalog.table_or(spark, "no_such_table", none) is none
        assert catalog.table_or(spark, "yard_one.cabs", none).count() == 2
        assert not writers.create_table_if_absent(none, "yard_one.cabs")
        assert writers.create_table_if_absent(spark.range(3), "yard_one.vans")
    finally:
        for place in ("yard_one", "yard_two"):
            spark.sql(f"DROP DATABASE {place} CASCADE")
        spark.catalog.dropTempView("cabs_view")


def test_insert_new(frame):
    target = frame("k string, at int", [("a", 1), ("b", 2)])
    batch = frame("k string, at int", [("b", 2), ("c", 3), ("c", 3), ("d", 4)])
    assert sorted(rows_of(incremental.insert_new(target, batch, "k"))) == [("c", 3), ("c", 3), ("d", 4)]
    assert sorted(rows_of(incremental.insert_new(target, batch, "k", dedup_batch=True))) == [("c", 3), ("d", 4)]
    assert sorted(rows_of(incremental.insert_new(target, batch, "k", within="at"))) == [("c", 3), ("c", 3), ("d", 4)]
    assert rows_of(incremental.insert_new(target, batch.limit(0), "k", within="at")) == []


def test_high_water(frame):
    source = frame("t timestamp", [(datetime(2024, 1, d),) for d in (1, 5, 6, 9)])
    target = frame("t timestamp", [(datetime(2024, 1, 6),)])
    days = lambda df: sorted(r.t.day for r in df.collect())
    assert days(incremental.rows_above_high_water(source, target, "t")) == [9]
    assert days(incremental.rows_above_high_water(source, target, "t", "3 days")) == [5, 6, 9]
    assert days(incremental.rows_above_high_water(source, target.limit(0), "t")) == [1, 5, 6, 9]


def test_upsert_adds_columns(frame):
    target = frame("k int, v string", [(1, "a"), (2, "b")])
    batch = frame("k int, v string, extra int", [(2, "B", 7), (3, "C", 8)])
    assert row_set(incremental.upsert(target, batch, "k")) == {(1, "a", None), (2, "B", 7), (3, "C", 8)}


def test_versions(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        incremental.published(spark, root)
    incremental.publish(frame("x int", [(1,)]), root)
    incremental.publish(incremental.published(spark, root).union(frame("x int", [(2,)])), root)
    assert row_set(incremental.published(spark, root)) == {(1,), (2,)}
    assert row_set(incremental.published(spark, root, version=0)) == {(1,)}
    # an unfinished version is not seen, and its number is used again
    (tmp_path / "t" / "v=1" / "_SUCCESS").unlink()
    assert row_set(incremental.published(spark, root)) == {(1,)}
    assert incremental.publish(frame("x int", [(3,)]), root).endswith("v=1")


def test_merge_partitions(spark, frame, tmp_path):
    root, schema = str(tmp_path / "fact"), "k int, v string, p string"
    assert incremental.merge_partitions(
        spark, frame(schema, [(1, "a", "2024-01"), (2, "b", "2024-02"), (4, "d", "2024-02")]), root, "k", "p") == ["2024-01", "2024-02"]
    before = committed.snapshot(spark, root).loads["p=2024-01"]
    batch = frame("k int, v string, p string, extra int", [(2, "B", "2024-02", 5), (3, "c", "2024-02", 6)])
    for _ in range(2):  # the second time changes nothing
        assert incremental.merge_partitions(spark, batch, root, "k", "p") == ["2024-02"]
    stored = committed.read_committed(spark, root).select("k", "v", "extra")
    assert row_set(stored) == {(1, "a", None), (2, "B", 5), (3, "c", 6), (4, "d", None)}
    assert committed.snapshot(spark, root).loads["p=2024-01"] == before
    assert incremental.merge_partitions(spark, batch.limit(0), root, "k", "p") == []


def test_refresh_fact(spark, frame, tmp_path):
    root, schema = str(tmp_path / "fact"), "trip_id string, pickup_datetime timestamp, n int"
    jobs.refresh_fact(spark, frame(schema, [("a", datetime(2024, 1, 5), 1), ("b", datetime(2024, 2, 5), 1)]), root)
    later = frame(schema, [("a", datetime(2024, 1, 5), 2), ("b", datetime(2024, 2, 5), 2), ("c", datetime(2024, 2, 6), 2)])
    assert jobs.refresh_fact(spark, later, root) == ["2024-02"]
    values = lambda: {r.trip_id: r.n for r in jobs.stored_fact(spark, root).collect()}
    assert values() == {"a": 1, "b": 1, "c": 2}
    jobs.refresh_fact(spark, later, root, look_back="90 days")
    assert values() == {"a": 2, "b": 2, "c": 2}
