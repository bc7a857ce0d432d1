"""Every registered query next to its SQL on DuckDB, over the smallest given tables."""

from __future__ import annotations

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as driver
from tools.check_oracle import TABLES, kind, plain
from tripflow.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")




@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    # bytes of files have no SQL form
    assert set(QUERIES) - set(ORACLES) == {"storage_audit"}


def test_driver_offers_them():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def check_plan(key: str, plan: str) -> None:
    """No Python in the plan, no cross join, no window that gathers all rows in one task."""
    if key not in ("score_batches", "json_array_records"):  # there Python is the operator
        assert not re.search(r"EvalPython|InPandas|InArrow", plan)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[+:]- Window \[", line):
            # a table clustered by the key needs no exchange
            exchange = next((later for later in lines[i:] if "Exchange" in later or "Bucketed: true" in later), "")
            assert exchange and "SinglePartition" not in exchange, line


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    check_plan(key, df._jdf.queryExecution().executedPlan().toString())
    columns = sorted(df.columns)
    rows = Counter(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if key not in ORACLES:
        assert rows
        return
    described = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[key]}").fetchall()}
    assert sorted(described) == columns
    types = dict(df.dtypes)
    assert {c: kind(types[c]) for c in columns} == {c: kind(described[c].replace(" ", "")) for c in columns}
    cursor = duck.execute(ORACLES[key])
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert rows == Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
