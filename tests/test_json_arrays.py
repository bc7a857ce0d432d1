"""JSON arrays cut at braces, next to a plain parser, with splits at every kind of place."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import row_set
from tripflow.schemas import declared
from tripflow.sources import json_arrays, readers


@pytest.fixture
def split_bytes(spark):
    """Files are read in splits of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "1g", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def records(spark, path, record_list=None):
    return [json.loads(r.record) for r in json_arrays.json_array_records(spark, str(path), record_list).collect()]


def same(found, wanted):
    order = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    assert order(found) == order(wanted)


TRICKY = [{"a": 1}, {"a": "}{][\",\\"}, {}, {"b": {"c": [{"d": "\\\\"}, []]}, "e": "é😀}"}, {"docs": [{"x": 1}], "f": "\"docs\": ["},
          {"g": [[], [[{}]]], "h": "\n\t{"}, {"long": "}" * 300 + "\\\"" * 50}, {"i": None, "j": [1, 2.5, True, "]"]}]


@pytest.mark.parametrize("size", [7, 16, 40, 100, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_whatever_the_splits(spark, tmp_path, split_bytes, size, indent):
    split_bytes(size)
    (tmp_path / "a.json").write_text(json.dumps(TRICKY, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps(TRICKY[::-1], ensure_ascii=True) + "\n")
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    same(records(spark, tmp_path), TRICKY * 2)


@pytest.mark.parametrize("size", [9, 33, 1 << 20])
def test_a_list_under_a_key(spark, tmp_path, split_bytes, size):
    split_bytes(size)
    pages = [{"n": 1, "meta": {"docs": [{"not": "this"}]}, "docs": TRICKY, "after": [{"nor": "that"}], "last": {}},
             {"docs": []}, {"other": "docs", "x": [{"no": 1}]}, {"docs": [{"z": 1}, 5, "s", [{"deep": 1}], None]}]
    (tmp_path / "page.json").write_text("\n".join(json.dumps(p) for p in pages))
    (tmp_path / "one.json").write_text(json.dumps(pages[0], indent=1))
    same(records(spark, tmp_path, "docs"), [*TRICKY, *TRICKY, {"z": 1}])


def test_objects_in_a_row_and_elements_that_are_none(spark, tmp_path, split_bytes):
    split_bytes(12)
    (tmp_path / "rows.json").write_text("\n".join(json.dumps(r) for r in TRICKY))
    (tmp_path / "mixed.json").write_text('[1, {"a": [1]}, "x{", [ {"inner": 1}, {"i": {}}, [{"k": 5}] ], {"b": 2}]')
    same(records(spark, tmp_path), [*TRICKY, {"a": [1]}, {"b": 2}])


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1', '[{"a": "x}', '{"docs": [{"a": 1}'])
def test_a_file_that_ends_too_early_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(ValueError, match="ends inside a value"):
        records(spark, tmp_path, "docs" if "docs" in text else None)


values = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text('ab"\\{}[]:, é\n', max_size=8),
                      lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('ad"\\{', max_size=3) | st.just("docs"),
                                                                              inner, max_size=3), max_leaves=12)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.text("ab}", max_size=2), values, max_size=3) | values, max_size=8), st.integers(5, 60), st.booleans())
def test_any_records(spark, tmp_path_factory, rows, size, keyed):
    """Split by split in Python alone, at every brace, as the two passes see them."""
    text = json.dumps({"a": {"docs": [{}]}, "docs": rows, "z": [{}]} if keyed else rows)
    key = "docs" if keyed else None
    rnd = random.Random(size)
    pieces, splits = text.split("}"), {}
    start = 0
    for n, piece in enumerate(pieces):
        if n and rnd.random() < 0.4:
            start = n
        splits.setdefault(start, []).append(piece)
    sums, found, parts = [], [], {}
    for first, held in splits.items():
        cases = [json_arrays.Sums(False), json_arrays.Sums(True)]
        for piece in held:
            for case in cases:
                case.take(piece + "}", key)
        sums.append({"file": "f", "start": first, "sums": json.dumps([text[0], *[c.told() for c in cases]])})
    starts = json_arrays._starts(sums, key)
    for first, held in splits.items():
        walk = json_arrays._Walk(starts["f", first], first, key, text[0] == "[")
        for piece in held:
            for opened, record in walk.take(piece + "}"):
                if opened == first:
                    found.append(json.loads(record))
                else:
                    parts.setdefault(opened, []).append((first, record))
        if walk.opened is not None and walk.parts:
            parts.setdefault(walk.opened, []).append((first, "".join(walk.parts)))
    found += [json.loads("".join(t for _, t in sorted(p))) for p in parts.values()]
    same(found, [r for r in rows if isinstance(r, dict)])


def test_a_large_file_is_read_by_many_tasks_in_pieces(spark, tmp_path, split_bytes):
    """A file of many Arrow batches on one line: the records of the plain reader, from several splits."""
    rows = [{"id": i, "name": f"n{i} }}{{ \"q\"", "tags": [{"t": i}], "price": i / 4} for i in range(60_000)]
    (tmp_path / "big").mkdir()
    (tmp_path / "big" / "a.json").write_text(json.dumps({"count": len(rows), "products": rows}))
    size = (tmp_path / "big" / "a.json").stat().st_size
    split_bytes(size // 7)
    path = str(tmp_path / "big")
    typed = json_arrays.read_json_array(spark, path, declared("id bigint, name string, price double"), "products")
    assert typed.count() == 60_000
    assert typed.agg(F.sum("id"), F.sum("price"), F.count_distinct("name")).head() == (
        sum(r["id"] for r in rows), sum(r["price"] for r in rows), 60_000)
    records_read = json_arrays.json_array_records(spark, path, "products")
    assert records_read.rdd.getNumPartitions() > 5
    chosen = readers.read_json_records(spark, path, ["id", "price", "none"], "products")
    assert chosen.where("none = 'N/A'").count() == 60_000
    assert row_set(chosen.where("id = '17'").select("price")) == {("4.25",)}
