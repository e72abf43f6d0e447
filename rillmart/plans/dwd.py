"""Detail tables from change records and logs. Every function takes batch or streaming frames unless noted.

An envelope frame has columns database, table, type, ts (seconds), data, old, row_time. In a stream its joins may be
given `bound`, the longest time between the joined records. Without it inner joins keep all records in their state and
find every pair; left joins need it, and `streaming.details.order_detail_versions` is the form without a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import times
from ..operators import cdc, enrich, joins, logs, routing, state

DELAY = "5 seconds"
LOG_DELAY = "20 seconds"


def _timed(df: DataFrame, delay: str) -> DataFrame:
    return df.withWatermark("row_time", delay) if df.isStreaming else df


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, bound: str | None) -> DataFrame:
    """Equi-join that keeps the left row_time. In a stream the right row lies within `bound` of the left one, if given."""
    if bound is None and how == "inner" or not left.isStreaming and not right.isStreaming:
        return left.join(right.drop("row_time"), on, how)
    if bound is None:
        raise ValueError("a left join of two streams needs a time bound")
    right = right.withColumnRenamed("row_time", "_r_time")
    return joins.interval(left, right, on, "row_time", "_r_time", bound, bound, how).drop("_r_time")


def base_log(messages: DataFrame, zone: str | None = None) -> DataFrame:
    """Log split with repaired new-visitor flags: rows (mid, ts, et, stream, value).

    Batch messages must come straight from storage, where logs may hold any number of copies of one record.
    """
    if messages.isStreaming:
        # A message passes the state as one text; its fields are read after that.
        heads = logs.heads(messages, keep=True).withWatermark("et", LOG_DELAY)
        repaired = logs.records(state.repair_is_new(heads, "mid", "et", "is_new", ("tie",), zone))
    else:
        repaired = state.repair_is_new(logs.parse(messages), "mid", "et", "is_new", ("tie",), zone,
                                       facts_from=logs.heads(messages), copies=True)
    return logs.tagged(logs.with_flag(repaired))


def base_db(envelope: DataFrame, config: DataFrame, mode: str = "exact") -> DataFrame:
    """Facts that need no join, routed by table and record type: sink_table, data.

    A configuration with history (`routing.config_versions`) routes each row by the version of its own time.
    """
    match = routing.match_as_of if "valid_from" in config.columns else routing.match
    matched = match(cdc.changes(envelope), config, by=("table", "type"))
    return routing.prune(matched, mode=mode).select("sink_table", "type", "ts", "data")


def comments(envelope: DataFrame, dic: DataFrame, database: str | None = None) -> DataFrame:
    keys = [name for name in schemas.COMMENT if name != "dic_name"]
    rows = cdc.slice(envelope, "comment_info", keys, database=database)
    return enrich.code(rows, dic, "appraise", "dic_name").select(schemas.COMMENT)


def cart_adds(envelope: DataFrame, database: str | None = None) -> DataFrame:
    rows = cdc.increases(envelope, "cart_info", "sku_num", database)
    keys = [name for name in schemas.CART_ADD if name not in ("sku_num", "ts")]
    return cdc.project(rows, keys, F.col("_change").alias("sku_num"), "ts").select(schemas.CART_ADD)


def order_detail(
    envelope: DataFrame, database: str | None = None, bound: str | None = None, delay: str = DELAY,
    marks: DataFrame | None = None, marked: Column | None = None,
) -> DataFrame:
    """Order lines with their order, and activity and coupon where there are any.

    `marks` (batch; order_id and `mark`, one row per order) adds the mark of a line's order. It is joined where the lines lie
    by order anyway; other lines go on with their id and `ts` alone, as they may still be the last of their id. `marked`, a condition
    on `row_time` and `mark`, may leave the mark out.
    """
    envelope = _timed(envelope, delay)
    lines = cdc.slice(
        envelope, "order_detail",
        ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "split_total_amount",
         "split_activity_amount", "split_coupon_amount"],
        "ts", "row_time", database=database,
    )
    orders = cdc.slice(envelope, "order_info", {"order_id": "id", "user_id": "user_id", "province_id": "province_id"},
                       "row_time", database=database)
    activities = cdc.slice(
        envelope, "order_detail_activity",
        {"id": "order_detail_id", "activity_id": "activity_id", "activity_rule_id": "activity_rule_id"},
        "row_time", database=database,
    )
    coupons = cdc.slice(envelope, "order_detail_coupon", {"id": "order_detail_id", "coupon_id": "coupon_id"},
                        "row_time", database=database)
    if marks is None and not envelope.isStreaming:
        return _by_line(lines, orders, activities, coupons).select(schemas.ORDER_DETAIL)
    wide = _join(lines, orders, ["order_id"], "inner", bound)
    if marks is not None:
        wide, kept = wide.join(marks, "order_id", "left"), ("id", "ts", "mark")
        wide = (wide if marked is None else wide.withColumn("mark", F.when(marked, F.col("mark")))).drop("row_time")
        wide = wide.select(*kept, *[F.when(F.col("mark").isNotNull(), F.col(name)).alias(name) for name in wide.columns
                                    if name not in kept])
    wide = _join(wide, activities, ["id"], "left", bound)
    wide = _join(wide, coupons, ["id"], "left", bound)
    return wide.select(*schemas.ORDER_DETAIL, *([] if marks is None else ["mark"]))


def _by_line(lines: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """Batch lines with their order, activity and coupon, where whole lines are shuffled once, by a hash of their id.

    A hash and the order id of each line go to the order and come back with what is taken from it. All joins are keyed by
    the hash alone, so the lines stay where they are; the ids themselves are compared by a range, as an equality would
    become a key too. A line without id is dealt out by its order. Equal orders are numbered, as what versions of one line
    bring back is taken once.
    """
    def equal(one: Column, other: Column) -> Column:
        return (one >= other) & (one <= other)

    place = F.hash(F.coalesce(F.col("id"), F.col("order_id")))
    found = orders.drop("row_time")
    equals = Window.partitionBy(*found.columns).orderBy("order_id")
    found = found.withColumn("_number", F.row_number().over(equals))
    placed = lines.select("order_id", place.alias("_place")).join(found, "order_id")
    placed = placed.withColumnRenamed("order_id", "_order_id").repartition("_place").distinct()
    wide = lines.filter("order_id IS NOT NULL").join(
        placed, (place == F.col("_place")) & equal(F.col("order_id"), F.col("_order_id")))
    for part in (activities, coupons):
        own = part.drop("row_time").filter("id IS NOT NULL").withColumnRenamed("id", "_id")
        wide = wide.join(own, (place == F.hash("_id")) & equal(F.col("id"), F.col("_id")), "left").drop("_id")
    return wide


def detail_table(details: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The order-detail upsert log as a table: the last version per id, with `row_time` (batch).

    `order` must put the versions of a line in order of arrival: all carry the `ts` of the line, so a log with
    corrections needs an offset or batch column here.
    """
    return state.latest(details, ["id"], list(order)).withColumn("row_time", times.from_epoch(F.col("ts"), "s"))


def _cancelled(envelope: DataFrame, database: str | None) -> DataFrame:
    cancelled = cdc.status_transition(
        envelope, "order_info", "order_status", schemas.ORDER_CANCELLED, schemas.ORDER_UNPAID, types=cdc.INSERTS,
        database=database,
    )
    return cdc.project(cancelled, {"order_id": "id", "operate_time": "operate_time"}, "ts", "row_time")


def cancels(envelope: DataFrame, order: tuple[str, ...] = ("ts",), database: str | None = None) -> DataFrame:
    """`order_cancels` of change records alone (batch), with the last details per line id by `order` (`id`, `ts`).

    The cancels of an order meet its lines before these are dealt out by id, so no wide row goes back to its order.
    """
    marks = _cancelled(envelope, database).groupBy("order_id").agg(
        F.collect_list(F.struct("operate_time", "ts")).alias("mark"))
    last = state.latest(order_detail(envelope, database, marks=marks), ["id"], list(order)).filter("mark IS NOT NULL")
    return last.drop("ts").select("*", F.inline("mark")).select(schemas.ORDER_CANCEL)


def order_cancels(
    envelope: DataFrame, details: DataFrame, database: str | None = None, bound: str | None = None, delay: str = DELAY
) -> DataFrame:
    """Cancelled orders with their lines. `details` has one row per line id (`detail_table`)."""
    envelope, details = _timed(envelope, delay), _timed(details, delay)
    cancelled = _cancelled(envelope, database)
    return _join(details.drop("ts"), cancelled, ["order_id"], "inner", bound).select(schemas.ORDER_CANCEL)


def _paid(envelope: DataFrame, database: str | None) -> DataFrame:
    paid = cdc.status_transition(envelope, "payment_info", "payment_status", schemas.PAYMENT_DONE, database=database)
    return cdc.project(
        paid, ["order_id", "user_id", "payment_type", "callback_time"], "ts", F.col("row_time").alias("pay_time")
    )


def payments_of_records(
    paid: DataFrame, envelope: DataFrame, dic: DataFrame, order: tuple[str, ...] = ("ts",), database: str | None = None,
    lower: str = "15 seconds", upper: str = "5 seconds",
) -> DataFrame:
    """`payments` of change records alone (batch), with the last details per line id by `order` (`id`, `ts`).

    A line that lies outside the time from the first to the last payment of its order matches none. That is seen where lines lie by
    order anyway, so the range join gets few wide rows.
    """
    marks = _paid(paid, database).groupBy("order_id").agg(
        F.struct(F.min("pay_time").alias("first"), F.max("pay_time").alias("last")).alias("mark"))
    near = (F.col("mark.last") >= F.col("row_time") - F.expr(f"INTERVAL {lower}")) & (
        F.col("mark.first") <= F.col("row_time") + F.expr(f"INTERVAL {upper}"))
    details = detail_table(order_detail(envelope, database, marks=marks, marked=near), order).filter("mark IS NOT NULL")
    return payments(paid, details.drop("mark"), dic, database, lower, upper)


def payments(
    envelope: DataFrame,
    details: DataFrame,
    dic: DataFrame,
    database: str | None = None,
    lower: str = "15 seconds",
    upper: str = "5 seconds",
    delay: str = DELAY,
) -> DataFrame:
    """Successful payments with the order lines created around them.

    The payment may precede the order record by `lower` and follow it by `upper`.
    """
    envelope, details = _timed(envelope, delay), _timed(details, delay)
    paid = _paid(envelope, database)
    matched = joins.interval(details.drop("ts", "user_id"), paid, ["order_id"], "row_time", "pay_time", lower, upper)
    named = enrich.code(matched, dic, "payment_type", "payment_type_name")
    return named.withColumnsRenamed({"payment_type": "payment_type_code", "callback_time": "payment_time"}).select(
        schemas.PAYMENT
    )


def refund_orders(
    envelope: DataFrame, dic: DataFrame, database: str | None = None, bound: str | None = None, delay: str = DELAY
) -> DataFrame:
    """Refund requests of orders in refund, with the names of refund type and reason."""
    envelope = _timed(envelope, delay)
    refunds = cdc.slice(
        envelope, "order_refund_info",
        {"id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
         "refund_type_code": "refund_type", "refund_num": "refund_num", "refund_amount": "refund_amount",
         "refund_reason_type_code": "refund_reason_type", "refund_reason_txt": "refund_reason_txt",
         "create_time": "create_time"},
        "ts", "row_time", database=database,
    )
    orders = cdc.status_transition(envelope, "order_info", "order_status", schemas.ORDER_REFUNDING, database=database)
    orders = cdc.project(orders, {"order_id": "id", "province_id": "province_id"}, "row_time")
    wide = _join(refunds, orders, ["order_id"], "inner", bound)
    wide = enrich.code(wide, dic, "refund_type_code", "refund_type_name")
    wide = enrich.code(wide, dic, "refund_reason_type_code", "refund_reason_type_name")
    date_id = times.text(times.parse(F.col("create_time")), times.DATE)
    return wide.withColumn("date_id", date_id).select(schemas.REFUND_ORDER)


def refund_payments(
    envelope: DataFrame, dic: DataFrame, database: str | None = None, bound: str | None = None, delay: str = DELAY
) -> DataFrame:
    """Paid-back refunds with the refund request and the refunded order."""
    envelope = _timed(envelope, delay)

    def done(table: str, column: str, status: str) -> DataFrame:
        return cdc.status_transition(envelope, table, column, status, database=database)

    paid = cdc.project(
        done("refund_payment", "refund_status", schemas.PAYMENT_DONE),
        {"id": "id", "order_id": "order_id", "sku_id": "sku_id", "payment_type_code": "payment_type",
         "callback_time": "callback_time", "refund_amount": "total_amount"},
        "ts", "row_time",
    )
    refunds = cdc.project(done("order_refund_info", "refund_status", schemas.REFUND_DONE),
                          ["order_id", "sku_id", "refund_num"], "row_time")
    orders = cdc.project(done("order_info", "order_status", schemas.ORDER_REFUNDED),
                         {"order_id": "id", "user_id": "user_id", "province_id": "province_id"}, "row_time")
    wide = _join(paid, refunds, ["order_id", "sku_id"], "inner", bound)
    wide = _join(wide, orders, ["order_id"], "inner", bound)
    wide = enrich.code(wide, dic, "payment_type_code", "payment_type_name")
    date_id = times.text(times.parse(F.col("callback_time")), times.DATE)
    return wide.withColumn("date_id", date_id).select(schemas.REFUND_PAYMENT)
