"""Sources and sinks of typed messages over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import enrich, reports, routing, state
from ..plans import dws
from ..sinks import topics
from ..sources import messages, tables
from . import shapes, sql
from .detail_queries import fact_routes
from .registry import QUERIES, query


def _messages(df, *columns):
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


@query("json_table", """
SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, CAST(NULL AS VARCHAR) AS lacking FROM customer""")
def json_table(spark, sf_dir):
    """A JSON topic as a table; a field that no message has is null."""
    customer = shapes.table(spark, sf_dir, "customer")
    sent = _messages(customer, "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
    return messages.as_table(sent, "c_custkey bigint, c_name string, c_acctbal decimal(12,2), lacking string")


@query("page_log_table", """
SELECT event_type AS page_id, CAST(user_id AS VARCHAR) AS item, epoch_us(ts) // 1000 AS ts,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS et FROM events""")
def page_log_table(spark, sf_dir):
    page = F.create_map(F.lit("page_id"), F.col("event_type"), F.lit("item"), shapes.text("user_id")).alias("page")
    events = shapes.table(spark, sf_dir, "events")
    sent = _messages(events, page, F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
    rows = tables.page_log(sent)
    return rows.select(F.col("page")["page_id"].alias("page_id"), F.col("page")["item"].alias("item"), "ts",
                       F.date_format("et", shapes.DATE_TIME).alias("et"))


@query("order_detail_table", """
SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_partkey AS VARCHAR) AS sku_id, count(*) AS versions,
       strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_time FROM lineitem GROUP BY ALL""")
def order_detail_table(spark, sf_dir):
    """The order-detail topic read back as a version log with event time."""
    lines = shapes.table(spark, sf_dir, "lineitem")
    sent = _messages(lines, F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
                     shapes.text("l_partkey").alias("sku_id"),
                     F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("ts"))
    return tables.order_details(sent).groupBy("id", "sku_id").agg(
        F.count("*").alias("versions"), F.date_format(F.max("row_time"), shapes.DATE_TIME).alias("last_time"))


@query("config_feed", """
SELECT n_name AS source_table, 'insert' AS source_type,
       'dwd_' || CASE WHEN n_nationkey % 3 = 0 THEN 'new' ELSE 'old' END AS sink_table, 'id' AS sink_columns
FROM nation WHERE n_nationkey % 5 <> 0""")
def config_feed(spark, sf_dir):
    """Configuration from its change feed: all rows created, every third one updated, every fifth one deleted."""
    nation = shapes.table(spark, sf_dir, "nation")

    def row(sink: str):
        return F.struct(F.col("n_name").alias("source_table"), F.lit("insert").alias("source_type"),
                        F.lit(sink).alias("sink_table"), F.lit("id").alias("sink_columns"))

    feed = None
    for at, (op, every, sink) in enumerate((("c", 1, "dwd_old"), ("u", 3, "dwd_new"), ("d", 5, "dwd_gone"))):
        side = "before" if op == "d" else "after"
        part = _messages(nation.filter(F.col("n_nationkey") % every == 0), F.lit(op).alias("op"), row(sink).alias(side),
                         F.lit(at).cast("bigint").alias("ts_ms"))
        feed = part if feed is None else feed.unionByName(part)
    start = spark.createDataFrame([], schemas.FACT_CONFIG)
    return routing.latest_config(start, tables.config_feed(feed, schemas.FACT_CONFIG))


@query("code_names", """
SELECT 'priority ' || o_orderpriority AS priority_name, count(*) AS order_count FROM orders GROUP BY ALL""")
def code_names(spark, sf_dir):
    """Codes translated through a code table in nested form, then counted."""
    orders = shapes.table(spark, sf_dir, "orders")
    flat = orders.select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("dic_code"),
        F.concat(F.lit("priority "), F.col("o_orderpriority")).alias("dic_name"))
    named = enrich.code(orders.select("o_orderpriority"), tables.code_table(flat), "o_orderpriority", "priority_name")
    return named.groupBy("priority_name").agg(F.count("*").alias("order_count"))


@query("routed_messages", f"SELECT sink_table AS topic, value FROM ({QUERIES['fact_routes'].sql})")
def routed_messages(spark, sf_dir):
    """Each row with its own destination, its data alone as the message."""
    routed = fact_routes(spark, sf_dir).withColumn("data", F.from_json("value", "map<string,string>"))
    return topics.routed(routed)


@query("delta_ttl", """
SELECT event_id, user_id, round(value - CASE WHEN ts <= lag(ts) OVER w + INTERVAL '1 hour' THEN lag(value) OVER w
       ELSE 0 END, 6) AS change
FROM (SELECT event_id, user_id, ts, coalesce(value, 0) AS value FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def delta_ttl(spark, sf_dir):
    """Changes since the version before; one older than an hour is forgotten."""
    rows = shapes.table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.coalesce("value", F.lit(0.0)).alias("value"))
    changed = state.delta(rows, ["user_id"], ["ts", "event_id"], ["value"], ttl="1 hour")
    return changed.select("event_id", "user_id", F.round("value", 6).alias("change"))


@query("report_of_today", f"""
SELECT {sql.window('1 day', 'o_orderdate')}, strftime(current_date, '%Y-%m-%d') AS cur_date, count(*) AS register_ct
FROM orders GROUP BY ALL""")
def report_of_today(spark, sf_dir):
    """Summaries are stamped with today and reported for today unless a day is given."""
    orders = shapes.table(spark, sf_dir, "orders").select(shapes.date_time(F.col("o_orderdate")).alias("create_time"))
    return reports.of_day(dws.registrations(orders, "1 day"))
