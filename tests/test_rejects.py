"""CSV lines that are no rows."""

from __future__ import annotations

import gzip
from collections import Counter
from datetime import datetime

import pytest

from tests.conftest import row_set, rows_of
from tripflow.schemas import declared
from tripflow.sources import rejects

SCHEMA = declared("id bigint, name string, price double, at timestamp")
GOOD = ["1,a,1.5,2024-01-01 10:00:00", "2,,2,2024-01-02 00:00:00", '3,"x,y",,', "4,b,1e3,2024-02-29 23:59:59", "5,,,"]
BAD = ["x,a,1.5,2024-01-01 10:00:00", "6,a,one,2024-01-01 10:00:00", "7,a,1.5,2024-02-30 10:00:00", "8,a,1.5",
       "9,a,1.5,2024-01-01 10:00:00,more", "only text", "10,a,1.5,yesterday"]


@pytest.fixture
def load(spark, tmp_path):
    def run(files, **options):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        for name, lines in files.items():
            text = "\n".join(["id,name,price,at", *lines]) + "\n"
            (folder / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
        return rejects.load_csv(spark, str(folder), SCHEMA, str(tmp_path / "out"), **options)
    return run


def test_rows_and_rejects_are_all_lines(load):
    found = load({"one.csv": GOOD[:3] + BAD[:4], "two.csv.gz": BAD[4:] + GOOD[3:]})
    assert row_set(found.rows().select("id", "name", "price", "at")) == {
        (1, "a", 1.5, datetime(2024, 1, 1, 10)), (2, None, 2.0, datetime(2024, 1, 2)), (3, "x,y", None, None),
        (4, "b", 1000.0, datetime(2024, 2, 29, 23, 59, 59)), (5, None, None, None)}
    assert Counter(r.line for r in found.rejects().collect()) == Counter(BAD)
    assert row_set(found.audit().select("filename", "n_loaded", "n_rejected")) == {("one.csv", 3, 4), ("two.csv.gz", 2, 3)}
    assert found.rows().columns == [*SCHEMA.fieldNames(), "filename"]
    by_line = {r.line: r.filename for r in found.rejects().collect()}
    assert by_line["8,a,1.5"] == "one.csv" and by_line["only text"] == "two.csv.gz"


def test_repeated_bad_lines_all_come_out(load):
    assert Counter(r.line for r in load({"a.csv": BAD[:1] * 3 + GOOD[:1] * 2}).rejects().collect()) == {BAD[0]: 3}


@pytest.mark.parametrize("lines, good, bad", [(GOOD, 5, 0), (BAD, 0, 7), ([], 0, 0)])
def test_all_good_all_bad_or_nothing(load, lines, good, bad):
    found = load({"a.csv": lines})
    assert (found.rows().count(), found.rejects().count()) == (good, bad)


def test_too_many_rejects_are_an_error_on_demand(load):
    assert load({"a.csv": GOOD + BAD[:1]}, most_share=0.2).rejects().count() == 1
    with pytest.raises(rejects.RejectedError, match="7 of 12"):
        load({"a.csv": GOOD + BAD}, most_share=0.5)


def test_without_header_and_again(spark, tmp_path, load):
    (tmp_path / "plain.csv").write_text("1,a,1,2024-01-01 00:00:00\nz,z\n")
    for _ in range(2):  # a repeated load replaces what it had written
        found = rejects.load_csv(spark, str(tmp_path / "plain.csv"), SCHEMA, str(tmp_path / "out2"), header=False)
        assert rows_of(found.rows().select("id")) == [(1,)] and rows_of(found.rejects().select("line")) == [("z,z",)]
    with pytest.raises(ValueError, match="filename"):
        rejects.load_csv(spark, "x", declared("filename string"), "y")
