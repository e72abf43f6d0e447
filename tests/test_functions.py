"""Scalar functions, windows and reports."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillmart.functions import naming, times, values
from rillmart.operators import joins, reports, windows


@pytest.fixture
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, value, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        text = F.lit("2024-03-01 08:00:00")
        assert value(times.date_time_to_ms(text, "+08:00")) == 1_709_251_200_000
        assert value(times.date_to_ms(F.lit("2024-03-01"), "+08:00")) == 1_709_222_400_000
        ms = F.lit(1_709_251_200_123)
        assert value(times.ms_to_date_time(ms, "Asia/Shanghai")) == "2024-03-01 08:00:00"
        assert value(times.ms_to_date(ms, "+08:00")) == "2024-03-01"
        assert value(times.ms_to_partition(ms, "-01:00")) == "20240229"
        assert value(times.day(F.timestamp_millis(ms), "+08:00")) == dt.date(2024, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_values(value):
    assert value(times.parse(F.lit("yesterday"))) is None
    assert value(values.money(F.lit("x"))) == Decimal("0.00")
    assert value(values.money(F.lit(None).cast("string"))) == Decimal("0.00")
    assert value(values.filled(F.lit(""))) is False


def test_report_day_defaults_to_today(value):
    assert value(times.as_of_day()) == value(F.current_date().cast("string"))
    assert value(times.as_of_day("2024-01-02")) == "2024-01-02"


def test_whole_days(value):
    later, earlier = F.to_timestamp(F.lit("2024-01-03 23:59:59")), F.to_timestamp(F.lit("2024-01-02 00:00:00"))
    assert value(times.whole_days_between(later, earlier)) == 1


def test_buckets_are_stable_and_in_range(spark):
    buckets = [r[0] for r in spark.range(500).select(values.bucket(F.col("id").cast("string"), 12)).collect()]
    assert set(buckets) == set(range(1, 13))


def test_names(spark):
    df = spark.range(1).select(F.lit(1).alias("category1Name"), F.lit(2).alias("uvCt"))
    assert naming.to_snake(df).columns == ["category1_name", "uv_ct"]
    assert naming.to_camel(naming.to_snake(df)).columns == ["category1Name", "uvCt"]


def stamped(spark, zone=None):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s), s) for s in (0, 4, 5, 12)], "et timestamp, v int")
    return windows.tumble(df, "et", "5 seconds", [], [F.sum("v").alias("v")], as_of="2024-01-09", zone=zone)


def test_tumbling_windows_skip_empty_ones(spark, rows):
    assert rows(stamped(spark)) == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:05", "2024-01-09", 4),
        ("2024-01-01 00:00:05", "2024-01-01 00:00:10", "2024-01-09", 5),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:15", "2024-01-09", 12),
    ]
    assert rows(stamped(spark, "+08:00"), "stt")[0] == ("2024-01-01 08:00:00",)


def test_distinct_counts_in_windows(spark, rows):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(at, "p", "o1", 1), (at, "p", "o1", 2), (at, "p", "o2", 3), (at, "q", "o1", 4)],
                               "et timestamp, p string, o string, v int")
    got = windows.tumble_distinct(df, "et", "5 seconds", ["p"], "o", "n", ("v",))
    assert rows(got, "p", "n", "v") == [("p", 2, 6), ("q", 1, 4)]


def test_range_join_bounds_are_inclusive(spark, rows):
    base = dt.datetime(2024, 1, 1, 12)
    left = spark.createDataFrame([("u", base)], "k string, lt timestamp")
    right = spark.createDataFrame(
        [("u", base + dt.timedelta(seconds=s), s) for s in (-16, -15, 0, 5, 6)] + [("v", base, 99)],
        "k string, rt timestamp, s int")
    assert rows(joins.interval(left, right, ["k"], "lt", "rt", "15 seconds", "5 seconds"), "s") == [(-15,), (0,), (5,)]


def test_range_join_against_all_pairs(spark):
    times_ = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=37 * n % 4001) for n in range(300)]
    left = spark.createDataFrame([(n % 3, t, n) for n, t in enumerate(times_)], "k int, lt timestamp, l int")
    right = spark.createDataFrame([(n % 3, t, n) for n, t in enumerate(reversed(times_))], "k int, rt timestamp, r int")
    got = {(r.l, r.r) for r in joins.interval(left, right, ["k"], "lt", "rt", "2 minutes", "10 seconds").collect()}
    wanted = {
        (a, b) for a, s in enumerate(times_) for b, t in enumerate(reversed(times_))
        if a % 3 == b % 3 and dt.timedelta(minutes=-2) <= t - s <= dt.timedelta(seconds=10)
    }
    assert got == wanted


def test_interval_lengths():
    assert [times.seconds(t) for t in ("15 seconds", "1 hour", "2 days", "500 milliseconds")] == [15, 3600, 172800, 0.5]


def test_reports(spark, rows):
    df = spark.createDataFrame(
        [("d1", "s1", Decimal(9)), ("d1", "s2", Decimal(100)), ("d2", "s3", Decimal(100)), ("d1", "s4", Decimal(100))],
        "cur_date string, shop_id string, amount decimal(20,2)")
    assert rows(reports.top_n(df, "amount", 2), "shop_id", "num") == [("s2", 1), ("s3", 2)]
    ranked = reports.ranked(df, "amount", ("cur_date",))
    assert rows(ranked, "cur_date", "shop_id", "num") == [("d1", "s1", 3), ("d1", "s2", 1), ("d1", "s4", 2), ("d2", "s3", 1)]
    assert rows(reports.total(df, "amount", "d1")) == [(Decimal("209.00"),)]
    assert rows(reports.of_day(df, "d2"), "shop_id") == [("s3",)]
    assert reports.of_day(df).count() == 0
    text = reports.envelope(reports.top_n(df, "amount", 2), order="num", columns={"shop_id": "Shop"}).first()[0]
    body = json.loads(text)
    assert body["status"] == 0 and body["data"]["columns"] == [{"name": "Shop", "id": "shop_id"}]
    assert [r["shop_id"] for r in body["data"]["rows"]] == ["s2", "s3"]
    assert json.loads(reports.envelope(df.limit(0), order="amount").first()[0])["data"] == []
