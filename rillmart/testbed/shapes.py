"""The test tables in warehouse shapes: page logs, change records, detail rows and dimensions.

Everything is derived inside the plan, so each job's work grows with the given tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc

DATABASE = "shop"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def decimal(name: str, precision: int = 12) -> Column:
    return F.col(name).cast(T.DecimalType(precision, 2))


def money_text(value: Column) -> Column:
    return value.cast(T.DecimalType(20, 2)).cast("string")


def date_time(ts: Column) -> Column:
    return F.date_format(ts, DATE_TIME)


def seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


# -- logs ------------------------------------------------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with number `k` taken from their properties."""
    return with_k(table(spark, sf_dir, "events"))


def with_k(rows: DataFrame) -> DataFrame:
    return rows.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _common() -> dict[str, Column]:
    k = F.col("k")
    return {
        "mid": F.concat(F.lit("m"), text("user_id")),
        "uid": F.when(k % 10 != 0, text("user_id")),
        "sid": F.concat_ws("-", text("user_id"), text(F.floor(k / 10))),
        "vc": F.concat(F.lit("v"), text(k % 3)),
        "ch": F.col("event_type"),
        "ar": F.concat(F.lit("a"), text(k % 5)),
        "is_new": F.when(k % 3 != 0, F.lit("1")).otherwise(F.lit("0")),
    }


def _page() -> dict[str, Column]:
    k, kind = F.col("k"), F.col("event_type")
    return {
        "page_id": F.when(kind == "view", "home").when(kind == "click", "good_detail")
                    .when(kind == "signup", "login").when(kind == "purchase", "search").otherwise("cart"),
        "last_page_id": F.when(k % 4 == 1, "login").when(k % 4 == 2, "search").when(k % 4 == 3, "home"),
        "item": F.concat_ws(" ", kind, F.concat(F.lit("K"), text(k % 7)), F.concat(F.lit("k"), text(k % 4))),
        "item_type": F.when(k % 2 == 0, "keyword").otherwise("sku_id"),
        "during_time": F.round(F.col("value") * 1000).cast("bigint"),
    }


def pages(rows: DataFrame) -> DataFrame:
    """Events (with k) as flat page logs."""
    columns = {**_common(), **_page(), "ts": F.unix_millis(F.col("ts").cast("timestamp"))}
    return rows.select(*[value.alias(name) for name, value in columns.items()])


def log_messages(rows: DataFrame) -> DataFrame:
    """Events (with k) as raw JSON log messages: start records for sign-ups, page records for the rest."""
    kind, k = F.col("event_type"), F.col("k")

    def struct(columns: dict[str, Column]) -> Column:
        return F.struct(*[value.alias(name) for name, value in columns.items()])

    numbers = F.sequence(F.lit(1), k % 3 + 1)
    displays = F.transform(numbers, lambda i: F.struct(i.alias("order"), F.concat(F.lit("s"), i).alias("item")))
    actions = F.array(F.struct(F.lit("cart_add").alias("action_id"), k.alias("item")))
    record = F.struct(
        struct(_common()).alias("common"),
        F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"), k.alias("loading_time"))).alias("start"),
        F.when(kind != "signup", struct(_page())).alias("page"),
        F.when(kind == "error", F.struct(k.alias("error_code"), F.lit("failed").alias("msg"))).alias("err"),
        F.when(kind.isin("view", "signup"), displays).alias("displays"),
        F.when(kind == "click", actions).alias("actions"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )
    return rows.select(F.to_json(record).alias("value"))


# -- change records --------------------------------------------------------------------------------------------------

def _map(columns: dict[str, Column]) -> Column:
    return F.create_map(*[part for name, value in columns.items() for part in (F.lit(name), value.cast("string"))])


def record(rows: DataFrame, name: str, kind: str, ts: Column, data: dict[str, Column], old: dict[str, Column] | None = None
           ) -> DataFrame:
    return rows.select(
        F.lit(DATABASE).alias("database"), F.lit(name).alias("table"), F.lit(kind).alias("type"), ts.alias("ts"),
        _map(data).alias("data"),
        (_map(old) if old else F.lit(None).cast("map<string,string>")).alias("old"),
    )


def union(*parts: DataFrame) -> DataFrame:
    return cdc.with_row_time(reduce(DataFrame.unionByName, parts))


def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders arrive unpaid (1001); P orders are cancelled, F orders refunded in two steps."""
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    later = F.col("o_orderdate") + F.expr("INTERVAL 1 hour")
    ts = seconds(F.col("o_orderdate"))

    def data(status: str, moment: Column | None = None) -> dict[str, Column]:
        return {
            "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"), "province_id": F.col("c_nationkey"),
            "order_status": F.lit(status), "operate_time": F.lit(None) if moment is None else date_time(moment),
        }

    def moved(status: str, before: str, to: str) -> DataFrame:
        return record(placed.filter(F.col("o_orderstatus") == status), "order_info", "update", ts + 3600,
                      data(to, later), {"order_status": F.lit(before)})

    return union(
        record(placed, "order_info", "insert", ts, data("1001")),
        moved("P", "1001", "1003"),
        moved("F", "1002", "1005"),
        moved("F", "1005", "1006"),
    )


def line_id() -> Column:
    parts = [text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *parts, F.date_format("l_shipdate", "yyyyMMdd"))


def line_amounts() -> dict[str, Column]:
    price, discount, tax = decimal("l_extendedprice"), decimal("l_discount", 4), decimal("l_tax", 4)
    return {
        "split_total_amount": money_text(price * (F.lit(1).cast(T.DecimalType(4, 2)) - discount)),
        "split_activity_amount": money_text(price * discount),
        "split_coupon_amount": money_text(price * tax),
    }


def _line_columns() -> dict[str, Column]:
    return {
        "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"),
        "sku_name": F.concat(F.lit("sku "), text("l_partkey")), "order_price": money_text(decimal("l_extendedprice")),
        "sku_num": F.col("l_quantity").cast("int"), "create_time": date_time(F.col("l_shipdate")), **line_amounts(),
    }


def order_lines(lineitem: DataFrame) -> DataFrame:
    """order_detail, order_detail_activity and order_detail_coupon records."""
    ts = seconds(F.col("l_shipdate"))
    key = {"order_detail_id": line_id()}
    return union(
        record(lineitem, "order_detail", "insert", ts, {"id": line_id(), **_line_columns()}),
        record(lineitem.filter("l_discount >= 0.05"), "order_detail_activity", "insert", ts,
               {**key, "activity_id": F.col("l_suppkey"), "activity_rule_id": F.col("l_linenumber")}),
        record(lineitem.filter("l_tax >= 0.04"), "order_detail_coupon", "insert", ts,
               {**key, "coupon_id": F.col("l_suppkey") + 1000}),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    paid = orders.filter(F.col("o_orderstatus").isin("F", "O"))
    data = {
        "id": F.col("o_orderkey"), "order_id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "payment_type": F.substring("o_orderpriority", 1, 1), "payment_status": F.lit("1602"),
        "callback_time": date_time(F.col("o_orderdate") + F.expr("INTERVAL 1 hour")),
    }
    return union(record(paid, "payment_info", "update", seconds(F.col("o_orderdate")) + 3600, data,
                        {"payment_status": F.lit("1601")}))


def refund_records(lineitem: DataFrame) -> DataFrame:
    """order_refund_info (inserted, then finished for F lines) and refund_payment records of returned lines."""
    returned = lineitem.filter("l_returnflag = 'R'")
    finished = returned.filter("l_linestatus = 'F'")
    ts = seconds(F.col("l_shipdate"))
    base = {"id": line_id(), "user_id": F.col("l_suppkey"), "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey")}
    refund = {
        **base, "refund_type": F.col("l_linestatus"), "refund_num": F.col("l_quantity").cast("int"),
        "refund_amount": money_text(decimal("l_extendedprice")),
        "refund_reason_type": F.concat(F.lit("r"), text("l_linenumber")),
        "refund_reason_txt": F.concat(F.lit("reason of "), line_id()), "create_time": date_time(F.col("l_shipdate")),
    }
    payment = {
        **base, "payment_type": F.col("l_linestatus"), "callback_time": date_time(F.col("l_shipdate")),
        "total_amount": money_text(decimal("l_extendedprice")), "refund_status": F.lit("1602"),
    }
    return union(
        record(returned, "order_refund_info", "insert", ts, {**refund, "refund_status": F.lit("0701")}),
        record(finished, "order_refund_info", "update", ts + 60, {**refund, "refund_status": F.lit("0705")},
               {"refund_status": F.lit("0701")}),
        record(finished, "refund_payment", "update", ts + 120, payment, {"refund_status": F.lit("1601")}),
    )


def comment_info(orders: DataFrame) -> DataFrame:
    data = {
        "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
        "nick_name": F.concat(F.lit("user "), text("o_custkey")), "sku_id": F.col("o_orderkey") % 1000,
        "spu_id": F.col("o_orderkey") % 100, "order_id": F.col("o_orderkey"),
        "appraise": F.substring("o_orderpriority", 1, 1), "comment_txt": F.col("o_orderpriority"),
        "create_time": date_time(F.col("o_orderdate")),
    }
    return union(record(orders, "comment_info", "insert", seconds(F.col("o_orderdate")), data))


def cart_info(rows: DataFrame) -> DataFrame:
    """Clicks insert carts, views change the number, sign-ups change something else."""
    data = {
        "id": F.col("event_id"), "user_id": F.col("user_id"), "sku_id": F.col("k"),
        "cart_price": money_text(F.col("value").cast(T.DecimalType(12, 2))),
        "sku_num": F.round("value").cast("int"), "sku_name": F.concat(F.lit("sku "), text("k")),
        "is_checked": F.lit("1"), "create_time": date_time(F.col("ts")), "operate_time": F.lit(None),
        "is_ordered": F.lit("0"), "order_time": F.lit(None),
    }
    ts = seconds(F.col("ts"))

    def of(kind: str) -> DataFrame:
        return rows.filter(F.col("event_type") == kind)

    return union(
        record(of("click"), "cart_info", "insert", ts, data),
        record(of("view"), "cart_info", "update", ts, data, {"sku_num": F.col("k") % 20}),
        record(of("signup"), "cart_info", "update", ts, data, {"is_checked": F.lit("0")}),
    )


def user_info(customer: DataFrame) -> DataFrame:
    """Customers inserted, and changed: a new balance only, or deleted."""
    ts = F.lit(1_700_000_000).cast("bigint") + F.col("c_custkey")
    data = {"id": F.col("c_custkey"), "name": F.col("c_name"), "segment": F.col("c_mktsegment"),
            "nation": F.col("c_nationkey")}
    return union(
        record(customer, "user_info", "bootstrap-insert", ts, data),
        record(customer.filter("c_custkey % 3 = 0"), "user_info", "update", ts + 10_000_000,
               {"id": F.col("c_custkey"), "name": F.lit(None), "segment": F.lit("CHANGED"), "nation": F.lit(None)}),
        record(customer.filter("c_custkey % 7 = 0"), "user_info", "delete", ts + 20_000_000, {"id": F.col("c_custkey")}),
        record(customer.filter("c_custkey % 14 = 0"), "user_info", "insert", ts + 30_000_000,
               {"id": F.col("c_custkey"), "name": F.lit("back"), "segment": F.lit(None), "nation": F.lit(None)}),
    )


# -- detail rows -----------------------------------------------------------------------------------------------------

def line_versions(lineitem: DataFrame) -> DataFrame:
    """Order lines as a version log: a line is (order, line number), and repeats of it are later versions."""
    columns = {"id": F.concat_ws("-", text("l_orderkey"), text("l_linenumber")),
               **{name: value.cast("string") for name, value in _line_columns().items()}}
    return lineitem.select(
        *[value.alias(name) for name, value in columns.items()], seconds(F.col("l_shipdate")).alias("ts"),
        text("l_suppkey").alias("supplier_id"), F.col("l_partkey"), F.col("l_suppkey"),
    )


def with_province(lines: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        text("o_orderkey").alias("order_id"), text("c_nationkey").alias("province_id"))
    return lines.join(placed, "order_id")


def returned_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter("l_returnflag = 'R'").select(
        text("l_suppkey").alias("user_id"), text("l_partkey").alias("sku_id"), text("l_orderkey").alias("order_id"),
        seconds(F.col("l_shipdate")).alias("ts"),
    )


# -- dimensions ------------------------------------------------------------------------------------------------------

def dims(part: DataFrame) -> dict[str, DataFrame]:
    """The sku snowflake from the part table; every 50th part is left out, and so are some parents."""
    kind = F.col("p_type")

    def distinct(**columns: Column) -> DataFrame:
        return part.select(*[value.cast("string").alias(name) for name, value in columns.items()]).distinct()

    return {
        "dim_sku_info": part.filter("p_partkey % 50 <> 0").select(
            text("p_partkey").alias("id"), text("p_size").alias("spu_id"), kind.alias("category3_id"),
            F.col("p_brand").alias("tm_id")),
        "dim_spu_info": distinct(id=F.col("p_size"), spu_name=F.concat(F.lit("spu "), text("p_size"))),
        "dim_base_trademark": distinct(id=F.col("p_brand"), tm_name=F.upper("p_brand")),
        "dim_base_category3": distinct(id=kind, name=F.lower(kind), category2_id=F.substring(kind, 1, 2)),
        "dim_base_category2": distinct(id=F.substring(kind, 1, 2), name=F.concat(F.lit("c2 "), F.substring(kind, 1, 2)),
                                       category1_id=F.substring(kind, 1, 1)),
        "dim_base_category1": distinct(id=F.substring(kind, 1, 1), name=F.concat(F.lit("c1 "), F.substring(kind, 1, 1)))
                              .filter("id <> 'S'"),
    }


def provinces(nation: DataFrame) -> DataFrame:
    return nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def shops(supplier: DataFrame) -> DataFrame:
    return supplier.select(text("s_suppkey").alias("id"), F.col("s_name").alias("name"))


def codes(orders: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    """The code table: priorities (without 4), and line status and line-number reasons (without r7)."""
    parts = [
        orders.filter("o_orderpriority <> '4-NOT SPECIFIED'").select(
            F.substring("o_orderpriority", 1, 1).alias("code"), F.expr("substring(o_orderpriority, 3)").alias("name"))
    ]
    if lineitem is not None:
        parts.append(lineitem.select(F.col("l_linestatus").alias("code"),
                                     F.concat(F.lit("status "), "l_linestatus").alias("name")))
        parts.append(lineitem.filter("l_linenumber <> 7").select(
            F.concat(F.lit("r"), text("l_linenumber")).alias("code"),
            F.concat(F.lit("reason "), text("l_linenumber")).alias("name")))
    # Each part is reduced to its few codes before the union.
    flat = reduce(DataFrame.unionByName, [part.distinct() for part in parts])
    return flat.select(F.col("code").alias("rowkey"), F.struct(F.col("name").alias("dic_name")).alias("info"))
