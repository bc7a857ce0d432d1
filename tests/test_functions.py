from __future__ import annotations

import hashlib
import math
from datetime import datetime

import pytest

from tests.conftest import rows_of
from tripflow import functions as fn
from tripflow.operators.nested import decode_or_reject, json_map_to_rows
from tripflow.operators.scoring import linear_duration_model, score_batches, score_expression
from tripflow.schemas import SURROGATE_KEY_NULL, declared


def column(df, expression):
    return [r[0] for r in df.select(expression.alias("x")).collect()]


ADDENDS = [(7, -2, 10), (None, 8, None), (5, None, -9), (-4, -4, None), (None, None, None)]


def test_safe_add(frame):
    df = frame("a int, b int, c int", ADDENDS)
    assert column(df, fn.safe_add(["a", "b", "c"])) == [sum(x or 0 for x in row) for row in ADDENDS]
    with pytest.raises(TypeError):
        fn.safe_add("a")


def test_safe_subtract(frame):
    df = frame("a int, b int, c int", ADDENDS)
    assert column(df, fn.safe_subtract(["a", "b", "c"])) == [(a or 0) - (b or 0) - (c or 0) for a, b, c in ADDENDS]


def test_safe_divide(frame):
    rows = [(9.0, 4.0), (-1.0, 8.0), (3.0, 0.0), (0.0, 0.0), (None, 2.0), (2.0, None), (None, None), (0.0, -3.0)]
    df = frame("a double, b double", rows)
    assert column(df, fn.safe_divide("a", "b")) == [None if a is None or not b else a / b for a, b in rows]


def test_width_bucket(frame):
    """Bounds of eight buckets belong to the bucket above; the end of the range is beyond it."""
    values = [9.99, 10.0, 14.99, 15.0, 31.0, 44.9, 45.0, 49.99, 50.0, 1e6, -3.0]
    df = frame("v double", [(v,) for v in values])
    by_hand = [0 if v < 10 else 9 if v >= 50 else int((v - 10) // 5) + 1 for v in values]
    assert column(df, fn.width_bucket("v", 10, 50, 8)) == by_hand


def test_haversine(frame):
    """Quarters and halves of great circles, and a point to itself."""
    df = frame("a double, b double, c double, d double", [
        (0.0, 0.0, 0.0, 90.0), (-90.0, 12.0, 90.0, 77.0), (0.0, -45.0, 90.0, 10.0), (51.5, -0.1, 51.5, -0.1)])
    quarter = 3961 * math.pi / 2
    assert column(df, fn.haversine("a", "b", "c", "d")) == pytest.approx([quarter, 2 * quarter, quarter, 0])
    kilometres = column(df, fn.haversine("a", "b", "c", "d", "km"))
    assert kilometres == pytest.approx([x * 1.60934 for x in (quarter, 2 * quarter, quarter, 0)])
    with pytest.raises(ValueError):
        fn.haversine("a", "b", "c", "d", "yd")


def test_url_host(frame):
    cases = {
        "http://trips.test:8080/map": "trips.test:8080",
        "HTTP://trips.test/map": "HTTP:",
        "https://a.b.trips.test": "a.b.trips.test",
        "android-app://rides.test/open/1": "rides.test",
        "trips.test?x=1/2": "trips.test",
        "https://?x": "",
    }
    df = frame("u string", [(u,) for u in cases])
    assert column(df, fn.url_host("u")) == list(cases.values())


def test_url_path(frame):
    cases = {
        "http://trips.test:8080/map#here": "map#here",
        "trips.test/a/b?from=1?to=2": "a/b",
        "https://trips.test/": "",
        "trips.test?zone=4": "",
        "trips.test": "trips.test",
    }
    df = frame("u string", [(u,) for u in cases])
    assert column(df, fn.url_path("u")) == list(cases.values())


def test_url_parameter(frame):
    df = frame("u string", [("trips.test/map?zone=7",), ("trips.test/map?zone=7&day=monday",),
                            ("trips.test/map?day=&zone=",), (None,)])
    assert column(df, fn.url_parameter("u", "zone")) == ["7", "7", None, None]
    assert column(df, fn.url_parameter("u", "day")) == [None, "monday", None, None]


def test_slugify(frame):
    df = frame("t string", [("Hello World-1",), ("1a",), ("",), ("A  - b!",)])
    expected = ["hello_world_1", "_1a", "", "a_b"]
    assert column(df, fn.slugify("t")) == expected
    assert [fn.slugify_text(t) for t in ["Hello World-1", "1a", "", "A  - b!"]] == expected


def test_surrogate_key(frame):
    df = frame("a string, b string", [("a", None), ("a", "")])

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert column(df, fn.surrogate_key(["a", "b"])) == [md5("a-" + SURROGATE_KEY_NULL), md5("a-")]
    assert column(df, fn.surrogate_key(["a", "b"], nulls_as_empty=True)) == [md5("a-"), md5("a-")]


def test_row_fingerprint_collides_only_without_delimiter(frame):
    df = frame("a string, b string", [("1", "23"), ("12", "3")])
    assert len(set(column(df, fn.row_fingerprint(["a", "b"], delimiter="")))) == 1
    assert len(set(column(df, fn.row_fingerprint(["a", "b"])))) == 2


def test_encode_base_id(frame):
    df = frame("b string", [("B00021",), ("B00009",), ("B00010",), ("Bx",), (None,), ("B" + "0" * 200 + "7",),
                            ("B6000000001",), ("B" + "9" * 30,)])
    assert column(df, fn.encode_base_id("b")) == ["s/15", "a/9", "e/A", None, None, "s/7", "e/165A0BC01", None]


def test_vendor_name(frame):
    df = frame("v int", [(1,), (2,), (4,), (3,)])
    assert column(df, fn.vendor_name("v")) == ["Creative Mobile Technologies", "VeriFone Inc.",
                                              "Unknown/Other", None]


def test_minutes_between_counts_boundaries(frame):
    at = datetime(2024, 1, 1)
    df = frame("a timestamp, b timestamp", [(at.replace(second=59), at.replace(minute=1, second=1)),
                                            (at, at.replace(second=59)),
                                            (at.replace(minute=2), at.replace(second=30))])
    assert column(df, fn.minutes_between("a", "b")) == [1, 0, -2]


@pytest.mark.parametrize("part, expected", [
    ("second", 86401), ("hour", 25), ("day", 1), ("week", 1), ("month", 1), ("quarter", 1), ("year", 1)])
def test_boundary_diff(frame, part, expected):
    df = frame("a timestamp, b timestamp", [(datetime(2023, 12, 31, 23, 59, 59),
                                             datetime(2024, 1, 2, 0, 0, 0))])
    expected = 2 if part == "day" else expected
    assert column(df, fn.boundary_diff(part, "a", "b")) == [expected]


def test_boundary_diff_rejects_unknown_part():
    with pytest.raises(ValueError):
        fn.boundary_diff("fortnight", "a", "b")


def test_time_text(frame):
    df = frame("t string", [("2025-10-01 12:30:00",), ("n/a",), (None,)])
    assert column(df, fn.parse_ts("t")) == [datetime(2025, 10, 1, 12, 30), None, None]
    assert column(df, fn.month_text(fn.parse_ts("t"))) == ["2025-10", None, None]


def test_epoch_ms(frame):
    df = frame("m bigint", [(1_700_000_000_123,)])
    assert column(df, fn.epoch_ms_to_ts("m")) == [datetime(2023, 11, 14, 22, 13, 20, 123000)]
    assert column(df, fn.ts_to_epoch_ms(fn.epoch_ms_to_ts("m"))) == [1_700_000_000_123]


def test_safe_cast(frame):
    df = frame("t string", [("12",), ("hello",), (None,)])
    assert column(df, fn.safe_cast("t", "bigint")) == [12, None, None]


def test_json_default(frame):
    df = frame("j string", [('{"title": "a", "brand": "b"}',), ('{"title": "c"}',)])
    assert rows_of(df.select(*fn.project_with_default("j", ["title", "brand"]))) == [("a", "b"), ("c", "N/A")]


def test_json_map_to_rows(frame):
    text = ('{"ISBN:0451526538": {"bib_key": "ISBN:0451526538", "title": "Tom Sawyer"}, '
            '"ISBN:0261103253": {"bib_key": "ISBN:0261103253", "title": "LOTR"}, "count": 2}')
    df = json_map_to_rows(frame("j string", [(text,)]), "j", declared("bib_key string, title string"), "isbn")
    assert sorted(rows_of(df)) == [("ISBN:0261103253", "ISBN:0261103253", "LOTR"),
                                   ("ISBN:0451526538", "ISBN:0451526538", "Tom Sawyer")]


def test_decode_or_reject(frame):
    df = frame("id int, j string", [(1, '{"k": 5}'), (2, '{"k": '), (3, '{"k": "x"}'), (4, None), (5, "{}")])
    good, bad = decode_or_reject(df, "j", declared("k int"))
    assert sorted(rows_of(good)) == [(1, 5), (5, None)]
    assert sorted(r[0] for r in rows_of(bad)) == [2, 3, 4]


def test_scores_agree(frame):
    df = frame("trip_distance double", [(1.5,), (10.0,)])
    by_batch = score_batches(df, linear_duration_model, ["trip_distance"])
    by_expression = df.withColumn("predicted_duration", score_expression("trip_distance"))
    assert sorted(rows_of(by_batch)) == sorted(rows_of(by_expression)) == [(1.5, 7.5), (10.0, 50.0)]
