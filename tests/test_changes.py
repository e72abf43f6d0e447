"""Change records: parsing, deltas, status moves, routing, dimension state."""

import json

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import cdc, enrich, routing
from rillmart.plans import dim, dwd
from rillmart.sinks import dims as dim_sink
from rillmart.sources import tables


@pytest.fixture
def envelope(spark):
    def build(*records):
        full = [{"database": "shop", "ts": 1_700_000_000, "old": None, **record} for record in records]
        df = spark.createDataFrame(
            [tuple(record.get(name) for name in schemas.ENVELOPE.names) for record in full], schemas.ENVELOPE)
        return cdc.with_row_time(df)

    return build


def messages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


GOOD = json.dumps({"database": "shop", "table": "t", "type": "insert", "ts": 5, "data": {"id": "1", "n": 2}})


def test_unreadable_records_are_dropped_kept_or_fatal(spark, rows):
    df = messages(spark, GOOD, "{broken", None)
    assert rows(cdc.parse(df).select(F.col("data")["n"])) == [("2",)]
    assert rows(cdc.parse(df, mode="keep").filter("_corrupt is not null"), "_corrupt") == [("{broken",)]
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        cdc.parse(messages(spark, "{broken"), mode="fail").collect()


def test_records_without_data_and_of_other_databases_drop(envelope, rows):
    df = envelope(
        {"table": "a", "type": "insert", "data": {"id": "1"}},
        {"table": "b", "type": "bootstrap-start", "data": {"id": "1"}},
        {"table": "c", "type": "insert", "data": {}},
        {"table": "d", "type": "insert", "data": None},
        {"table": "e", "type": "insert", "data": {"id": "1"}, "database": "other"},
    )
    assert rows(cdc.changes(df, "shop", cdc.BOOTSTRAP_MARKS), "table") == [("a",)]
    assert rows(cdc.changes(df), "table") == [("a",), ("b",), ("e",)]


def test_cart_adds(envelope, rows):
    def cart(number, kind, new, old=None):
        return {"table": "cart_info", "type": kind, "data": {"id": str(number), "sku_num": new}, "old": old}

    df = envelope(
        cart(1, "insert", "4"), cart(2, "bootstrap-insert", "1"), cart(3, "update", "5", {"sku_num": "2"}),
        cart(4, "update", "2", {"sku_num": "5"}), cart(5, "update", "9", {"is_checked": "0"}), cart(6, "delete", "9"),
        cart(7, "update", "10", {"sku_num": "9"}),
    )
    added = dwd.cart_adds(df, "shop")
    assert added.columns == schemas.CART_ADD
    assert rows(added, "id", "sku_num") == [("1", 4), ("2", 1), ("3", 3), ("7", 1)]


def test_status_moves(envelope, rows):
    def order(number, kind, status, before=None):
        old = {"order_status": before} if before else {"x": "y"}
        return {"table": "order_info", "type": kind, "data": {"id": str(number), "order_status": status},
                "old": old if kind == "update" else None}

    df = envelope(
        order(1, "update", "1003", "1001"), order(2, "update", "1003", "1002"), order(3, "insert", "1003"),
        order(4, "bootstrap-insert", "1003"), order(5, "update", "1003"), order(6, "update", "1004", "1001"),
    )

    def moved(**options):
        return rows(cdc.status_transition(df, "order_info", "order_status", "1003", **options).select(F.col("data")["id"]))

    assert moved(from_="1001", types=cdc.INSERTS) == [("1",), ("3",), ("4",)]
    assert moved() == [("1",), ("2",), ("4",)]


def test_codes_translate_and_unknown_codes_drop(spark, rows):
    dic = tables.code_table(spark.createDataFrame([("1", "good"), ("2", "bad")], "dic_code string, dic_name string"))
    df = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "id string, c string")
    assert rows(enrich.code(df, dic, "c", "name")) == [("a", "1", "good")]


def test_unknown_sku_keeps_its_row(spark, rows):
    def table(columns, *values):
        return spark.createDataFrame(values, ", ".join(f"{c} string" for c in columns.split()))

    dims = {
        "dim_sku_info": table("id spu_id category3_id tm_id", ("s1", "p1", "c3", "t1"), ("s2", "p9", "c39", "t9")),
        "dim_spu_info": table("id spu_name", ("p1", "spu")),
        "dim_base_trademark": table("id tm_name", ("t1", "brand")),
        "dim_base_category3": table("id name category2_id", ("c3", "three", "c2")),
        "dim_base_category2": table("id name category1_id", ("c2", "two", "c1")),
        "dim_base_category1": table("id name", ("c1", "one")),
    }
    df = table("sku_id", ("s1",), ("s2",), ("s3",))
    got = enrich.sku_hierarchy(df, dims).select("sku_id", "spu_name", "trademark_id", "trademark_name", "category1_name")
    assert rows(got) == [("s1", "spu", "t1", "brand", "one"), ("s2", None, "t9", None, None),
                         ("s3", None, None, None, None)]


def test_routing_by_table_and_type(spark, envelope, rows):
    config = spark.createDataFrame([("u", "insert", "new_u", "id,user_name"), ("u", "update", "moved_u", "id")],
                                   schemas.FACT_CONFIG)
    df = envelope(
        {"table": "u", "type": "bootstrap-insert", "data": {"id": "1", "user_name": "a", "name": "b"}},
        {"table": "u", "type": "update", "data": {"id": "2", "user_name": "c"}},
        {"table": "u", "type": "delete", "data": {"id": "3"}},
        {"table": "v", "type": "insert", "data": {"id": "4"}},
    )
    def routed(**options):
        return sorted((r.sink_table, dict(r.data)) for r in dwd.base_db(df, config, **options).collect())

    assert routed() == [("moved_u", {"id": "2"}), ("new_u", {"id": "1", "user_name": "a"})]
    assert routed(mode="substring")[1] == ("new_u", {"id": "1", "user_name": "a", "name": "b"})


def test_config_changes_replace_and_remove(spark, rows):
    snapshot = spark.createDataFrame(
        [("a", "insert", "a0", "id"), ("b", "insert", "b0", "id"), ("c", "insert", "c0", "id")], schemas.FACT_CONFIG)
    feed = spark.createDataFrame(
        [("u", None, ("a", "bootstrap-insert", "a1", "id"), 10), ("d", ("b", "insert", "b0", "id"), None, 11),
         ("c", None, ("d", "insert", "d1", "id"), 12), ("d", ("d", "insert", "d1", "id"), None, 13),
         ("c", None, ("d", "insert", "d2", "id"), 14)],
        schemas.config_change(schemas.FACT_CONFIG).add("ts_ms", "long"))
    current = routing.latest_config(snapshot, feed, by=("table", "type"))
    assert rows(current, "source_table", "sink_table") == [("a", "a1"), ("c", "c0"), ("d", "d2")]


def test_dimension_state(spark, rows):
    changes = spark.createDataFrame(
        [("1", "insert", 1, {"id": "1", "a": "x", "b": "y"}), ("1", "update", 2, {"id": "1", "a": None, "b": "z"}),
         ("2", "insert", 1, {"id": "2", "a": "x"}), ("2", "delete", 2, {"id": "2"}),
         ("3", "insert", 1, {"id": "3", "a": "old", "b": "old"}), ("3", "delete", 2, {}),
         ("3", "insert", 3, {"id": "3", "a": "new"})],
        "row_key string, type string, ts long, data map<string,string>")
    assert rows(dim.snapshot(changes, ["id", "a", "b"])) == [("1", "1", "x", "z"), ("3", "3", "new", None)]


def test_routing_does_not_exchange_records(spark, envelope):
    """Records stay where they are while the configuration is small; a large one is joined without a broadcast."""
    config = spark.createDataFrame([("t", "insert", "s", "id")], schemas.FACT_CONFIG)
    records = envelope({"table": "t", "type": "insert", "data": {"id": "1"}})
    plan = dwd.base_db(records, config)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert not enrich.small(config, rows=0) and not enrich.small(config, size=10)
    assert enrich.small(config) and enrich.small(config.limit(0))


def test_compacted_dimensions_read_as_before(spark, tmp_path):
    def change(table, key, kind, ts, **data):
        return (table, key, kind, ts, data)

    batches = [
        [change("d", "1", "insert", 1, a="x", b="y"), change("d", "2", "insert", 1, a="x"), change("e", "1", "insert", 1, a="e")],
        [change("d", "1", "update", 2, a="z", b=None), change("d", "2", "delete", 2), change("d", "3", "insert", 2, a=None)],
        [change("d", "2", "insert", 3, b="again"), change("d", "4", "delete", 3)],
    ]
    path, target = str(tmp_path / "log"), str(tmp_path / "compact")
    for batch, found in enumerate(batches):
        dim_sink.append(spark.createDataFrame(found, dim_sink.CHANGES), path, batch)
    dim_sink.compact(spark, path, target)

    def read(folder, table="d"):
        return sorted(map(tuple, dim_sink.read(spark, folder, table, ["a", "b"]).collect()))

    assert read(target) == read(path) == [("1", "z", "y"), ("2", None, "again"), ("3", None, None)]
    assert read(target, "e") == [("1", "e", None)]
    dim_sink.append(spark.createDataFrame([change("d", "1", "update", 9, b="new")], dim_sink.CHANGES), target, 7)
    assert read(target)[0] == ("1", "z", "new")
    assert spark.read.parquet(target).filter("type = 'delete'").isEmpty()


def _line(order, ts, line="d", amount="1"):
    data = {"id": line, "order_id": order, "sku_id": "s", "split_total_amount": amount}
    return ("shop", "order_detail", "insert", ts, data, None)


def _order(name, status="1001", ts=0, kind="insert", old=None):
    return ("shop", "order_info", kind, ts, {"id": name, "order_status": status, "user_id": "u", "operate_time": str(ts)}, old)


# Versions of one line in several orders, an order cancelled twice, lines of orders that are unknown or go on.
AWKWARD = [_order("o1"), _order("o2"), _order("o3"), *[_order("o1", "1003", t, "update", {"order_status": "1001"}) for t in (50, 60)],
           _line("o1", 5, amount="2"), _line("o2", 9), _line("o1", 4, "e"), _line("o2", 2, "e"), _line("o3", 3, "f"), _line("o9", 3, "g"),
           ("shop", "order_detail_coupon", "insert", 4, {"order_detail_id": "e", "coupon_id": "c"}, None)]


def test_cancels_of_change_records_are_those_of_the_details(spark, rows):
    envelope = cdc.with_row_time(spark.createDataFrame(AWKWARD, schemas.ENVELOPE))
    details = dwd.detail_table(dwd.order_detail(envelope), ("ts",))
    found = dwd.cancels(envelope)
    assert rows(found) == rows(dwd.order_cancels(envelope, details)) and found.columns == schemas.ORDER_CANCEL
    assert rows(found, "id", "coupon_id", "operate_time") == [("e", "c", "50"), ("e", "c", "60")]


def test_payments_of_change_records_are_those_of_the_details(spark, rows):
    def pay(order, ts):
        data = {"order_id": order, "user_id": "p", "payment_type": "1", "payment_status": "1602", "callback_time": str(ts)}
        return ("shop", "payment_info", "update", ts, data, {"payment_status": "1601"})

    envelope = cdc.with_row_time(spark.createDataFrame(AWKWARD, schemas.ENVELOPE))
    # o1: the last version of d lies in o2; e lies between two payments, near one of o2's, and on both ends of the range.
    paid = cdc.with_row_time(spark.createDataFrame(
        [pay("o1", 0), pay("o1", 9), pay("o1", 2), pay("o2", 100), pay("o3", 13), pay("o3", -7), pay("o3", 3), pay("o9", 3)],
        schemas.ENVELOPE))
    dic = spark.createDataFrame([("1", ("card",))], "rowkey string, info struct<dic_name:string>")
    details = dwd.detail_table(dwd.order_detail(envelope), ("ts",))
    for lower, upper in (("15 seconds", "5 seconds"), ("10 seconds", "10 seconds"), ("2 seconds", "3 seconds")):
        found = dwd.payments_of_records(paid, envelope, dic, lower=lower, upper=upper)
        wanted = rows(dwd.payments(paid, details, dic, lower=lower, upper=upper))
        assert rows(found) == wanted and wanted and found.columns == schemas.PAYMENT


def test_lines_are_shuffled_once_whatever_their_ids(spark, rows):
    """Whole lines were shuffled to their orders and again by id. Repeated, missing and contradictory ids give what plain joins give."""
    def of(table, data):
        return ("shop", table, "insert", 5, data, None)

    ids, orders = ["a", "a", "b", "", None, None, "c"], ["o1", "o1", "o2", "o1", "o1", "o3", None]
    lines = [*zip(ids, orders), ("a", "o2"), ("a", "o2"), ("d", "lost"), ("e", "o1"), ("", "o3")]
    placed = [("o1", "u1"), ("o1", "u2"), ("o2", "u3"), ("o3", None), (None, "u4")]
    activities = [("a", "x"), ("a", "y"), ("", "z"), (None, "n"), ("c", "w"), ("b", None)]
    coupons = [("a", "k"), ("e", "k"), ("e", "l"), (None, "n")]
    records = [
        *[of("order_detail", {"id": i, "order_id": o, "sku_id": str(n)}) for n, (i, o) in enumerate(lines)],
        *[of("order_info", {"id": o, "user_id": u}) for o, u in placed],
        *[of("order_detail_activity", {"order_detail_id": i, "activity_id": a}) for i, a in activities],
        *[of("order_detail_coupon", {"order_detail_id": i, "coupon_id": c}) for i, c in coupons]]
    df = dwd.order_detail(cdc.with_row_time(spark.createDataFrame(records, schemas.ENVELOPE)), "shop")
    wanted = [(i, o, str(n), u, a, c) for n, (i, o) in enumerate(lines) for p, u in placed if o is not None and o == p
              for a in [a for d, a in activities if i is not None and d == i] or [None]
              for c in [c for d, c in coupons if i is not None and d == i] or [None]]
    got = rows(df, "id", "order_id", "sku_id", "user_id", "activity_id", "coupon_id")
    assert got == sorted(wanted, key=str)

    def shuffled(node):
        children = node.children()
        below = [name for n in range(children.size()) for name in shuffled(children.apply(n))]
        return below + [node.output().mkString(",")] * (node.nodeName() == "Exchange")

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().initialPlan()
        assert len([names for names in shuffled(plan) if "sku_name" in names]) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
