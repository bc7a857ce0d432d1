from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import row_set
from tripflow.plans import hire, jobs, marts, reports, staging
from tripflow.schemas import GREEN_FEED, HIRE_FEED, PAYMENT_TYPE_ROWS, PAYMENT_TYPES, YELLOW_FEED, ZONES
from tripflow.sources.readers import seed

TRIP = {
    "VendorID": 1, "pickup": datetime(2019, 1, 5, 10, 0, 0), "dropoff": datetime(2019, 1, 5, 10, 20, 30),
    "store_and_fwd_flag": "N", "RatecodeID": 1, "PULocationID": 74, "DOLocationID": 75,
    "passenger_count": 1, "trip_distance": 2.5, "fare_amount": 10.0, "extra": 0.5, "mta_tax": 0.5,
    "tip_amount": 1.0, "tolls_amount": 0.0, "improvement_surcharge": 0.3, "total_amount": 12.3,
    "payment_type": 1, "trip_type": 1, "congestion_surcharge": 0.0, "ehail_fee": None,
}


@pytest.fixture
def feed(spark):
    def build(which: staging.Feed, *changes: dict, month="2019-01"):
        schema = GREEN_FEED if which is staging.GREEN else YELLOW_FEED
        rows = []
        for change in changes:
            trip = {**TRIP, **change}
            trip[which.pickup], trip[which.dropoff] = trip.pop("pickup"), trip.pop("dropoff")
            rows.append(tuple(trip[f.name] for f in schema.fields))
        return (spark.createDataFrame(rows, schema)
                .withColumns({"unique_row_id": F.lit("id"),
                              "filename": F.lit(f"{which.service.lower()}_tripdata_{month}.csv.gz")}))
    return build


BAD = [
    {"VendorID": None}, {"passenger_count": 7}, {"passenger_count": None}, {"trip_distance": 50.01},
    {"trip_distance": -1.0}, {"dropoff": TRIP["pickup"]}, {"PULocationID": 266}, {"DOLocationID": 0},
    {"total_amount": 2.49}, {"total_amount": 500.01}, {"fare_amount": 0.0}, {"payment_type": 5},
    {"payment_type": None}, {"RatecodeID": 99}, {"RatecodeID": None}, {"mta_tax": 0.8}, {"extra": 0.7},
    {"pickup": datetime(2019, 2, 1), "dropoff": datetime(2019, 2, 2)},
]


@pytest.mark.parametrize("change", BAD, ids=lambda c: "-".join(c) + "=" + str(list(c.values())[0]))
def test_staging_filter_drops(feed, change):
    assert staging.stage_feed(feed(staging.GREEN, change), staging.GREEN).count() == 0


@pytest.mark.parametrize("change", [{}, {"trip_distance": 50.0}, {"total_amount": 500.0}, {"extra": 3.5},
                                    {"passenger_count": 0}, {"RatecodeID": 6}, {"mta_tax": 0.0}])
def test_staging_filter_keeps(feed, change):
    assert staging.stage_feed(feed(staging.GREEN, change), staging.GREEN).count() == 1


def test_feeds_differ_in_distance_and_trip_type(feed):
    far = {"trip_distance": 99.0}
    assert staging.stage_feed(feed(staging.GREEN, far), staging.GREEN).count() == 0
    yellow = staging.stage_feed(feed(staging.YELLOW, far), staging.YELLOW)
    assert yellow.count() == 1 and "trip_type" not in yellow.columns


def test_bad_identifiers_become_null(feed):
    raw = feed(staging.GREEN, {}).withColumn("RatecodeID", F.lit("n/a"))
    assert staging.stage_trips(raw, staging.GREEN).head().rate_code_id is None


def test_dev_window(feed):
    raw = feed(staging.GREEN, {}, {"pickup": datetime(2019, 1, 31, 23, 59, 59), "dropoff": datetime(2019, 2, 1)})
    assert staging.stage_feed(raw, staging.GREEN, "2019-01-01", "2019-01-31").count() == 1
    assert staging.stage_feed(raw, staging.GREEN).count() == 2


@pytest.fixture
def fact(spark, feed):
    zones = spark.createDataFrame([(74, "Manhattan", "East Harlem", "Boro Zone")], ZONES)
    green = feed(staging.GREEN, {}, {"dropoff": datetime(2019, 1, 5, 10, 5), "total_amount": 99.0},
                 {"PULocationID": 75, "DOLocationID": 74, "payment_type": 2})
    yellow = feed(staging.YELLOW, {})
    return jobs.build_fact(green, yellow, seed(spark, PAYMENT_TYPE_ROWS, PAYMENT_TYPES), zones)


def test_fact(fact):
    rows = {(r.service_type, r.pickup_location_id): r for r in fact.collect()}
    assert len(rows) == 3 and len(fact.columns) == 27
    first = rows["Green", 74]  # the earlier dropoff wins
    assert (first.total_amount, first.trip_duration_minutes) == (D("99.0000"), 5)
    assert (first.pickup_zone, first.pickup_borough, first.dropoff_zone) == ("East Harlem", "Manhattan", None)
    assert first.payment_type_description == "Credit card" and first.trip_type == 1
    unknown = rows["Green", 75]
    assert (unknown.pickup_zone, unknown.dropoff_zone, unknown.payment_type_description) == (None, "East Harlem", "Cash")
    assert rows["Yellow", 74].trip_type == 1
    assert len({r.trip_id for r in rows.values()}) == 3


def test_mart_and_vendors(fact):
    mart = {(r.pickup_zone, r.revenue_month, r.service_type): r for r in reports.monthly_zone_revenue(fact).collect()}
    assert set(mart) == {("East Harlem", date(2019, 1, 1), "Green"), ("Unknown Zone", date(2019, 1, 1), "Green"),
                         ("East Harlem", date(2019, 1, 1), "Yellow")}
    row = mart["East Harlem", date(2019, 1, 1), "Green"]
    assert (row.revenue_monthly_total_amount, row.total_monthly_trips) == (D("99.0000"), 1)
    assert row.avg_monthly_passenger_count == 1.0
    assert row_set(marts.dim_vendors(fact)) == {(1, "Creative Mobile Technologies")}


def test_unknown_zone_folds_with_its_name(spark, fact):
    named = fact.withColumn("pickup_zone", F.when(F.col("service_type") == "Green", F.lit(None))
                            .otherwise("Unknown Zone")).withColumn("service_type", F.lit("all"))
    assert reports.monthly_zone_revenue(named).count() == 1


def test_money_is_exact(frame):
    df = frame("g int, x double", [(1, 0.1)] * 1000 + [(1, -0.05), (2, None)])
    sums = {r.g: r.s for r in df.groupBy("g").agg(reports.money_sum(df, "x").alias("s")).collect()}
    assert sums == {1: D("99.95"), 2: None}
    exact = df.withColumn("x", F.col("x").cast("decimal(18,4)"))
    assert exact.agg(reports.money_sum(exact, "x")).head()[0] == D("99.95")
    wide = df.withColumn("x", F.col("x").cast("decimal(38,9)"))
    assert wide.agg(reports.money_sum(wide, "x")).head()[0] == D("99.95")
    small = frame("x double", [(0.000004,)] * 3 + [(-1.5,)])
    assert small.agg(reports.exact_sum(small, "x")).head()[0] == D("-1.499988")
    floats = frame("x float", [(0.1,)] * 10)
    assert floats.agg(reports.exact_sum(floats, "x")).head()[0] == D("1.000000000")
    means = df.where("g = 1").agg(reports.exact_mean(df, "x", 2)).head()[0]
    assert round(means, 2) == D("0.10")
    assert df.where("g = 2").agg(reports.exact_mean(df, "x", 2)).head()[0] is None


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf"), 1e300])
def test_money_that_is_no_number_is_an_error(frame, bad):
    df = frame("x double", [(1.0,), (bad,)])
    with pytest.raises(Exception, match="CAST_OVERFLOW|CAST_INVALID_INPUT"):
        df.agg(reports.money_sum(df, "x")).collect()


def test_sums_round_each_value_unless_strict(frame):
    df = frame("x double", [(0.1 + 0.2,)] * 7 + [(-1e-10,), (4e-10,), (-12345678.5,), (1e-9,)])
    assert df.agg(reports.exact_sum(df, "x")).head()[0] == D("-12345676.4") + D("1e-9")
    with pytest.raises(Exception, match="is no number of at most 9 decimals"):
        df.agg(reports.exact_sum(df, "x", strict=True)).collect()
    plain = df.where("x = 1e-9")
    assert plain.agg(reports.money_sum(plain, "x", "decimal(18,9)", strict=True)).head()[0] == D("1e-9")
    for order in ("x", "-x"):  # whatever the order of the rows
        assert df.orderBy(F.expr(order)).agg(reports.exact_sum(df, "x")).head()[0] == D("-12345676.399999999")


def test_money_overflow_is_an_error(frame):
    df = frame("x double", [(99_999_999.0,), (2.0,)])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.agg(reports.money_sum(df, "x", "decimal(10,2)")).collect()


def test_hourly_reports_meet(frame):
    schema = "at timestamp, zone int, amount double"
    green = frame(schema, [(datetime(2020, 1, 1, 9, 5), 1, 2.5), (datetime(2020, 1, 1, 9, 50), 1, 1.0),
                           (datetime(2019, 12, 31, 9), 1, 7.0)])
    yellow = frame(schema, [(datetime(2020, 1, 1, 9, 30), 2, 4.0)])
    one, two = (reports.hourly_revenue(df, "at", "zone", "amount", "2020-01-01 00:00:00") for df in (green, yellow))
    both = reports.hourly_revenue_both(one, two)
    hour = datetime(2020, 1, 1, 9)
    assert row_set(both) == {(hour, 1, D("3.50"), 2, None, None), (hour, 2, None, None, D("4.00"), 1)}
    zones = frame("location_id int, borough string, zone string", [(1, "B", "Z")])
    named = reports.with_zone_names(both, zones)
    assert named.columns == ["hour", "green_amount", "green_number_records", "yellow_amount",
                             "yellow_number_records", "borough", "zone_name"]
    assert named.count() == 1


def test_clean_trips(frame):
    df = frame("trip_distance double, passenger_count int, fare_amount double",
               [(1.0, 1, 5.0), (0.0, 1, 5.0), (1.0, None, 5.0), (1.0, 1, 0.0)])
    good, audit = staging.clean_trips(df)
    assert good.count() == 1 and row_set(audit) == {(4, 1)}


def test_hire_days(spark):
    trips = spark.createDataFrame([("HV0003", "B00021", datetime(2021, 1, 1, 23, 50), datetime(2021, 1, 2, 0, 10),
                                    74, 75, None)], HIRE_FEED)
    assert row_set(hire.hire_days(trips)) == {("B00021", "s/15", date(2021, 1, 1), date(2021, 1, 2), 74, 75)}


def test_load_and_backfill(spark, feed, tmp_path):
    later = {"pickup": datetime(2019, 2, 5, 9), "dropoff": datetime(2019, 2, 5, 10)}
    csv, out = tmp_path / "csv", str(tmp_path / "lake")
    csv.mkdir()
    names = staging.GREEN.schema.fieldNames()

    def land(name, *changes):
        rows = feed(staging.GREEN, *changes).select(*names).toPandas()
        rows.to_csv(csv / f"{name}.csv.gz", index=False, date_format="%Y-%m-%d %H:%M:%S")

    land("green_tripdata_2019-01", {}, {"VendorID": 2})
    land("green_tripdata_2019-02", later)
    loaded = jobs.load_feed(spark, str(csv), staging.GREEN)
    assert {r.filename[:22] for r in loaded.collect()} == {"green_tripdata_2019-01", "green_tripdata_2019-02"}
    assert loaded.select("unique_row_id").distinct().count() == 3
    # loaded rows are what staging expects, down to the month in the file name
    assert staging.stage_feed(loaded, staging.GREEN).count() == 3
    for _ in range(2):
        jobs.backfill(spark, str(csv), staging.GREEN, out)
    stored = spark.read.parquet(out)
    assert {(r.service, r.year, r.month) for r in stored.collect()} == {("green", 2019, 1), ("green", 2019, 2)}
    assert stored.count() == 3


def test_monthly_job(spark, feed, tmp_path):
    for which in (staging.GREEN, staging.YELLOW):
        feed(which, {}, {"VendorID": 2}).drop("unique_row_id", "filename").write.parquet(
            str(tmp_path / which.service / "2019" / "01"))
    out = str(tmp_path / "report")
    jobs.monthly_revenue_job(spark, str(tmp_path / "Green"), str(tmp_path / "Yellow"), out)
    rows = {r.service_type: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"green", "yellow"}
    assert rows["green"].revenue_zone == 74 and rows["green"].revenue_monthly_fare == D("20.00")


def test_reports_job(spark, fact, tmp_path):
    jobs.refresh_fact(spark, fact, str(tmp_path / "fact"))
    jobs.build_reports(spark, str(tmp_path / "fact"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "monthly_zone_revenue")).count() == 3
    assert len(list((tmp_path / "out" / "dim_vendors").glob("part-*"))) == 1


def test_staged_numbers_are_rounded_or_fail(frame):
    df = frame("x double, s string", [(1.2345, "1.2345"), (None, None), (0.1 + 0.2, "0.30000000000000004"),
                                      (1.2999999523, "-0.0000000005")])
    number = staging.rounded_number
    assert row_set(df.select(number("x"), number("s"))) == {
        (D("1.234500000"), D("1.234500000")), (None, None), (D("0.300000000"), D("0.300000000")),
        (D("1.299999952"), D("-0.000000001"))}
    with pytest.raises(Exception, match="x does not fit"):
        df.select(number("x", strict=True)).collect()
    assert df.where("x < 0.31").select(number("x", "decimal(38,17)", True)).head()[0] == D("0.30000000000000004")
    large = frame("x double", [(1e12,)])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        large.select(number("x")).collect()
    assert large.select(number("x", "decimal(38,9)")).head()[0] == D("1e12")


NOISE = [0.0, 5e-10, -5e-10, 4.999999999e-10, -4.999999999e-10, 1e-9, -1e-9, 1e-17, -1e-17, 0.1 + 0.2 - 0.3, -0.0]


def test_rules_on_raw_numbers_are_those_of_the_staged_ones(feed):
    """Values around every bound: the row stays exactly if its rounded number passes."""
    def rounded(x):
        return D(repr(x)).quantize(D("1e-9"), rounding="ROUND_HALF_UP")

    rules = {"trip_distance": (lambda x: 0 <= x <= 50, [0.0, 50.0]),
             "total_amount": (lambda x: D("2.5") <= x <= 500, [2.5, 500.0]),
             "fare_amount": (lambda x: x > 0, [0.0]),
             "mta_tax": (lambda x: x in (0, D("0.5")), [0.0, 0.5, 0.3]),
             "extra": (lambda x: x in map(D, ("0", "0.5", "1", "2.5", "3", "3.5")), [0.0, 0.5, 1.0, 2.5, 3.0, 3.5, 2.0])}
    changes, wanted = [], []
    for name, (good, bounds) in rules.items():
        for value in {b + e for b in bounds for e in NOISE}:
            changes.append({name: value, "VendorID": len(changes)})
            if good(rounded(value)):
                wanted.append(len(changes) - 1)
    changes += [{name: None, "VendorID": 10_000} for name in rules]
    kept = staging.stage_feed(feed(staging.GREEN, *changes), staging.GREEN).collect()
    assert sorted(r.vendor_id for r in kept) == wanted
    by_id = {r.vendor_id: r for r in kept}
    for i in wanted:
        (name, value), _ = changes[i].items()
        assert by_id[i][name] == rounded(value)


def test_a_bad_amount_in_a_dropped_row_is_no_error(feed):
    rows = feed(staging.GREEN, {}, {"tip_amount": float("inf"), "passenger_count": 9}, {"trip_distance": 1e300})
    assert staging.stage_feed(rows, staging.GREEN).count() == 1
    assert len(staging.stage_feed(rows, staging.GREEN).collect()) == 1


def test_reports_take_the_noise_of_doubles(spark, feed):
    rows = [{"total_amount": 0.1 + 0.2, "fare_amount": 1.2999999523, "trip_distance": 0.1 * 3, "tip_amount": -0.1 * 3}] * 10
    trips = (feed(staging.GREEN, *rows).withColumnsRenamed(
        {"PULocationID": "pickup_location_id", "lpep_pickup_datetime": "pickup_datetime"})
        .withColumn("service_type", F.lit("Green")))
    month = reports.monthly_revenue_decimal(trips).head()
    assert (month.revenue_monthly_total_amount, month.revenue_monthly_fare, month.revenue_monthly_tip_amount) == (
        D("3.00"), D("13.00"), D("-3.00"))
    report, day = reports.monthly_report(trips).head(), reports.daily_stats(trips).head()
    assert (report.total, report.avg_distance, day.daily_revenue, day.avg_distance) == (D("3.00"), 0.3, D("3.00"), D("0.30"))
    assert reports.hourly_revenue(trips, "pickup_datetime", "pickup_location_id", "total_amount",
                                  "2019-01-01").head().amount == D("3.00")
    assert reports.revenue_pairs(trips, "pickup_datetime", "pickup_location_id", "total_amount").head().revenue == D("3.00")


def test_mart_of_trips_equals_mart_of_fact(spark, frame):
    columns = ", ".join(f"{c} decimal(18,4)" for c in [*reports.MONEY_COLUMNS, "trip_distance"])
    trips = frame(f"pickup_location_id int, pickup_datetime timestamp, service_type string, "
                  f"passenger_count int, trip_id string, {columns}", [
        (zone, datetime(2020, 1 + i % 2, 3), "Green", i % 3 or None, str(i), *[D(i)] * 9)
        for i, zone in enumerate([1, 2, 2, 3, 9, None, 1, 2])])
    dim = frame("location_id int, zone string", [(1, "A"), (2, "A"), (3, "Unknown Zone")])
    fact = trips.join(dim, trips.pickup_location_id == dim.location_id, "left").withColumnRenamed("zone", "pickup_zone")
    exact = reports.monthly_zone_revenue(fact)
    direct = reports.monthly_zone_revenue_of_trips(trips, dim)
    rounded = lambda df: {tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                          for r in df.withColumn("avg_monthly_trip_distance", F.col(
                              "avg_monthly_trip_distance").cast("double")).select(*exact.columns).collect()}
    assert rounded(exact) == rounded(direct)
