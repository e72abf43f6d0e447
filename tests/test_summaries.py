"""Summary jobs on hot lines and repeated versions."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rillmart.operators import skew
from rillmart.plans import dwd, dws
from rillmart.sinks import upserts
from rillmart.streaming import queries

COLUMNS = "id string, sku_id string, sku_name string, order_id string, province_id string, order_price string, " \
          "sku_num string, split_total_amount string, split_activity_amount string, split_coupon_amount string, ts long"


def version(number, line, amount, seconds, sku="s1"):
    return (line, sku, f"name {sku}", f"o{number % 3}", "p", str(amount), "2", str(amount), None, "1", 1_700_000_000 + seconds)


@pytest.fixture
def details(spark):
    hot = [version(n, "hot", n % 7, n // 4, f"s{n % 2}") for n in range(200)]
    copies = [version(0, "hot", 5, 20)] * 150
    rest = [version(n, f"d{n % 40}", n, n) for n in range(120)]
    return spark.createDataFrame(hot + copies + rest, COLUMNS)


@pytest.fixture
def dims(spark):
    def table(columns):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns.split()))

    return {
        "dim_sku_info": table("id spu_id category3_id tm_id"), "dim_spu_info": table("id spu_name"),
        "dim_base_trademark": table("id tm_name"), "dim_base_category3": table("id name category2_id"),
        "dim_base_category2": table("id name category1_id"), "dim_base_category1": table("id name"),
    }


@pytest.mark.parametrize("limit", [15, 60])
def test_hot_lines_give_the_same_sums(spark, details, dims, rows, limit):
    heavy = skew.heavy_keys(details, ["id"], limit)
    assert heavy
    plain, split = (dws.sku_orders(details, dims, ("et",), as_of="2024-01-01", heavy=h) for h in (skew.Heavy({}), heavy))
    assert rows(plain) == rows(split)
    provinces = spark.createDataFrame([("p", "north")], "id string, name string")
    plain, split = (dws.province_orders(details, provinces, ("et",), as_of="2024-01-01", heavy=h) for h in (skew.Heavy({}), heavy))
    assert rows(plain) == rows(split)


def test_amounts_and_missing_values(spark, dims):
    df = spark.createDataFrame([version(1, "a", 10, 0), version(1, "a", 13, 1), version(2, "", 1, 1, "")], COLUMNS)
    row = dws.sku_orders(df, dims, ("et",), as_of="2024-01-01").collect()
    assert len(row) == 1
    assert (row[0].original_amount, row[0].order_amount, row[0].activity_reduce_amount, row[0].coupon_reduce_amount) == (
        D("26.00"), D("13.00"), D("0.00"), D("1.00"))
    assert row[0].sku_name == "name s1" and row[0].trademark_id is None


def test_refunds_count_orders_once(spark, dims, rows):
    df = spark.createDataFrame([("u", "s", "o1", 5), ("u", "s", "o1", 6), ("u", "s", "o2", 7), ("u", "s", "o3", 0)],
                               "user_id string, sku_id string, order_id string, ts long")
    assert rows(dws.refunds(df, dims, "1 hour", as_of="2024-01-01"), "user_id", "refund_count") == [("u", 2)]


def test_shops_by_stable_hash(spark, rows):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:01", "5"), ("a", "2024-01-01 00:00:09", "6"), ("b", "bad", "7")],
                               "id string, create_time string, split_total_amount string")
    shops = spark.createDataFrame([], "id string, name string")
    got = dws.shop_amounts(df, shops, as_of="2024-01-01").collect()
    assert [(r.amount, r.edt) for r in got] == [(D("11.00"), "2024-01-01 00:00:10")] and 1 <= int(got[0].shop_id) <= 12


def test_a_smaller_correction_of_the_same_second_counts_by_arrival(spark):
    rows = [("1", "9", "7", "10.00", 1_700_000_000, 0), ("1", "9", "7", "5.00", 1_700_000_000, 1)]
    log = spark.createDataFrame(rows, "id string, province_id string, order_id string, split_total_amount string, "
                                      "ts bigint, arrival int").withColumn("et", F.timestamp_seconds("ts"))
    provinces = spark.createDataFrame([("9", "north")], "id string, name string")
    row = dws.province_orders(log, provinces, ("et", "arrival"), as_of="2024-01-01").first()
    assert str(row["order_amount"]) == "5.00" and row["order_count"] == 1


def test_the_last_version_of_a_line_is_told_by_arrival(spark):
    log = spark.createDataFrame([("1", "a", 5, 1), ("1", None, 5, 0)], "id string, activity_id string, ts bigint, arrival int")
    assert dwd.detail_table(log, ("ts", "arrival")).first()["activity_id"] == "a"


def test_refunds_of_a_stream_keep_one_state(spark, dims, rows, feed, tmp_path):
    """The counts of closed windows went through a second state; each window is counted once, in the micro-batch that closes it."""
    schema = "user_id string, sku_id string, order_id string, ts long"
    first = [("u", "s", "o1", 5), ("u", "s", "o2", 7), ("v", "s", "o1", 3700), ("u", "t", "o1", 9), (None, "s", "o1", 11), ("u", "s", "o3", 0)]
    second = [("u", "s", "o1", 20), ("u", "s", "o4", 3000), ("v", "s", "o1", 7300), ("v", "s", "o2", 3900)]
    third = [("u", "s", "late", 30), ("v", "s", "o9", 7400), ("w", "s", "open", 50_000)]
    parts = [spark.createDataFrame(part, schema) for part in (first, second, third)]
    items = dws.refund_items(feed("refunds", *parts), dims, "1 hour")
    query = queries.with_live_tables(items, str(tmp_path / "c"), lambda: dims,
                                     lambda found, known: dws.refund_counts(found, known, "2024-01-01"), str(tmp_path / "out"), once=True)
    query.awaitTermination()
    assert all(len(p["stateOperators"]) == 1 for p in query.recentProgress)
    kept = spark.createDataFrame([row for row in first + second + third if row[2] not in ("late", "open")], schema)
    wanted = dws.refunds(kept, dims, "1 hour", as_of="2024-01-01")
    got = spark.read.parquet(str(tmp_path / "out")).drop(upserts.BATCH)
    assert got.columns == wanted.columns and rows(got) == rows(wanted) and got.filter("user_id = 'u'").count() == 1
