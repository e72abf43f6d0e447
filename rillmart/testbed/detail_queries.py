"""Detail and dimension jobs on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, session
from ..functions import values
from ..operators import logs, routing
from ..plans import dim, dwd, dws
from . import shapes, sql
from .registry import AS_OF, query


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [shapes.table(spark, sf_dir, name) for name in names]


def _orders(spark, sf_dir) -> DataFrame:
    return shapes.order_info(*_tables(spark, sf_dir, "orders", "customer"))


def _codes(spark, sf_dir, *names: str) -> DataFrame:
    """The code table, derived from the data once."""
    return session.settled(shapes.codes(*_tables(spark, sf_dir, *(names or ("orders", "lineitem")))))


@query("comments", f"""
WITH {sql.CODES}
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, 'user ' || o_custkey AS nick_name,
       CAST(o_orderkey % 1000 AS VARCHAR) AS sku_id, CAST(o_orderkey % 100 AS VARCHAR) AS spu_id,
       CAST(o_orderkey AS VARCHAR) AS order_id, substring(o_orderpriority, 1, 1) AS appraise, dic_name,
       o_orderpriority AS comment_txt, {sql.moment('o_orderdate')} AS create_time
FROM orders JOIN dic ON rowkey = substring(o_orderpriority, 1, 1)""")
def comments(spark, sf_dir):
    (orders,) = _tables(spark, sf_dir, "orders")
    return dwd.comments(shapes.comment_info(orders), _codes(spark, sf_dir, "orders"), shapes.DATABASE)


@query("cart_delta", f"""
WITH {sql.EVENTS}, cart AS (
  SELECT *, CAST(round(value) AS BIGINT) AS num, k % 20 AS old_num FROM ev WHERE event_type IN ('click', 'view')
)
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS sku_id,
       CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) AS cart_price,
       CASE event_type WHEN 'click' THEN num ELSE num - old_num END AS sku_num, 'sku ' || k AS sku_name,
       '1' AS is_checked, {sql.moment('ts')} AS create_time, CAST(NULL AS VARCHAR) AS operate_time, '0' AS is_ordered,
       CAST(NULL AS VARCHAR) AS order_time, CAST(floor(epoch(ts)) AS BIGINT) AS ts
FROM cart WHERE event_type = 'click' OR num > old_num""")
def cart_delta(spark, sf_dir):
    return dwd.cart_adds(shapes.cart_info(shapes.events(spark, sf_dir)), shapes.DATABASE)


def detail_topic(spark, sf_dir) -> DataFrame:
    """Change records of orders and their lines."""
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    return _orders(spark, sf_dir).unionByName(shapes.order_lines(lineitem))


def _details(spark, sf_dir) -> DataFrame:
    return dwd.order_detail(detail_topic(spark, sf_dir), shapes.DATABASE)


_DETAIL = ("id, order_id, sku_id, user_id, province_id, activity_id, activity_rule_id, coupon_id, sku_name, "
           "order_price, sku_num, create_time, split_total_amount, split_activity_amount, split_coupon_amount")


@query("order_detail", f"WITH {sql.LINES}, {sql.PLACED} SELECT {_DETAIL}, ts FROM ln JOIN od USING (order_id)")
def order_detail(spark, sf_dir):
    return _details(spark, sf_dir)


@query("cancels", f"""
WITH {sql.LINES}, {sql.PLACED}
SELECT {_DETAIL}, {sql.moment("o_orderdate + INTERVAL '1 hour'")} AS operate_time,
       CAST(epoch(o_orderdate) AS BIGINT) + 3600 AS ts
FROM ln JOIN od USING (order_id) WHERE o_orderstatus = 'P'""")
def cancels(spark, sf_dir):
    return dwd.cancels(detail_topic(spark, sf_dir), ("ts",), shapes.DATABASE)


@query("payments", f"""
WITH {sql.LINES}, {sql.PLACED}, {sql.CODES}
SELECT {_DETAIL.replace(' create_time,', '')}, rowkey AS payment_type_code, dic_name AS payment_type_name,
       {sql.moment("o_orderdate + INTERVAL '1 hour'")} AS payment_time, CAST(epoch(o_orderdate) AS BIGINT) + 3600 AS ts
FROM ln JOIN od USING (order_id) JOIN dic ON rowkey = substring(o_orderpriority, 1, 1)
WHERE o_orderstatus IN ('F', 'O')
  AND o_orderdate + INTERVAL '1 hour' BETWEEN l_shipdate - INTERVAL '30 days' AND l_shipdate + INTERVAL '40 days'""")
def payments(spark, sf_dir):
    """Ship dates stand in for order times, so the range is in days here."""
    (orders,) = _tables(spark, sf_dir, "orders")
    return dwd.payments_of_records(shapes.payment_info(orders), detail_topic(spark, sf_dir), _codes(spark, sf_dir, "orders"),
                                   ("ts",), shapes.DATABASE, lower="30 days", upper="40 days")


@query("refund_orders", f"""
WITH {sql.LINES}, {sql.PLACED}, {sql.CODES}
SELECT ln.id, CAST(l_suppkey AS VARCHAR) AS user_id, order_id, sku_id, province_id,
       strftime(l_shipdate, '%Y-%m-%d') AS date_id, create_time, l_linestatus AS refund_type_code,
       t.dic_name AS refund_type_name, r.rowkey AS refund_reason_type_code, r.dic_name AS refund_reason_type_name,
       'reason of ' || ln.id AS refund_reason_txt, sku_num AS refund_num, order_price AS refund_amount, ts
FROM ln JOIN od USING (order_id) JOIN dic t ON t.rowkey = l_linestatus JOIN dic r ON r.rowkey = 'r' || l_linenumber
WHERE l_returnflag = 'R' AND o_orderstatus = 'F'""")
def refund_orders(spark, sf_dir):
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    topic = _orders(spark, sf_dir).unionByName(shapes.refund_records(lineitem))
    return dwd.refund_orders(topic, _codes(spark, sf_dir), shapes.DATABASE)


@query("refund_payments", f"""
WITH {sql.LINES}, {sql.PLACED}, {sql.CODES}, back AS (
  SELECT * FROM ln WHERE l_returnflag = 'R' AND l_linestatus = 'F'
)
SELECT p.id, od.user_id, p.order_id, p.sku_id, province_id, p.l_linestatus AS payment_type_code,
       dic_name AS payment_type_name, strftime(p.l_shipdate, '%Y-%m-%d') AS date_id, p.create_time AS callback_time,
       o.sku_num AS refund_num, p.order_price AS refund_amount, p.ts + 120 AS ts
FROM back p JOIN back o ON o.order_id = p.order_id AND o.sku_id = p.sku_id
JOIN od ON od.order_id = p.order_id JOIN dic ON rowkey = p.l_linestatus WHERE o_orderstatus = 'F'""")
def refund_payments(spark, sf_dir):
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    topic = _orders(spark, sf_dir).unionByName(shapes.refund_records(lineitem))
    return dwd.refund_payments(topic, _codes(spark, sf_dir), shapes.DATABASE)


# -- logs ------------------------------------------------------------------------------------------------------------

REPAIRED = sql.PAGES + """, hist AS (
  SELECT *, CAST(et AS DATE) AS d,
         last_value(CASE WHEN is_new = '0' THEN CAST(et AS DATE) - 1 END IGNORE NULLS) OVER w AS old_day,
         first_value(CASE WHEN is_new = '1' THEN CAST(et AS DATE) END IGNORE NULLS) OVER w AS new_day
  FROM pg WINDOW w AS (PARTITION BY mid ORDER BY et ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fixed AS (
  SELECT * EXCLUDE (is_new), CASE WHEN is_new = '1' AND coalesce(old_day, new_day) IS NOT NULL
         AND coalesce(old_day, new_day) <> d THEN '0' ELSE is_new END AS is_new
  FROM hist
)"""

_LOG_COLUMNS = "mid, is_new, page_id, entry, error_code, display_item, action_item, ts"


@query("log_split", f"""
WITH {REPAIRED}, logs AS (
  SELECT f.*, e.k, e.event_type FROM fixed f JOIN ev e ON 'm' || e.user_id = f.mid AND epoch_us(e.ts) // 1000 = f.ts
)
SELECT stream, mid, is_new, page_id, entry, error_code, display_item, action_item, ts FROM (
  SELECT 'err' AS stream, mid, is_new, page_id, CAST(NULL AS VARCHAR) AS entry, CAST(k AS VARCHAR) AS error_code,
         CAST(NULL AS VARCHAR) AS display_item, CAST(NULL AS VARCHAR) AS action_item, ts
  FROM logs WHERE event_type = 'error'
  UNION ALL SELECT 'start', mid, is_new, NULL, 'icon', NULL, NULL, NULL, ts FROM logs WHERE event_type = 'signup'
  UNION ALL SELECT 'display', mid, is_new, page_id, NULL, NULL, 's' || i, NULL, ts
  FROM (SELECT *, unnest(range(1, k % 3 + 2)) AS i FROM logs WHERE event_type = 'view')
  UNION ALL SELECT 'action', mid, is_new, page_id, NULL, NULL, NULL, CAST(k AS VARCHAR), ts
  FROM logs WHERE event_type = 'click'
  UNION ALL SELECT 'page', mid, is_new, page_id, NULL, NULL, NULL, NULL, ts FROM logs WHERE event_type <> 'signup'
)""")
def log_split(spark, sf_dir):
    out = dwd.base_log(shapes.log_messages(shapes.events(spark, sf_dir)))
    return split_fields(out)


def split_fields(out: DataFrame) -> DataFrame:
    """Fields of the split messages that tell whether each record went where it should."""
    schema = ("common struct<mid:string,is_new:string>, page struct<page_id:string>, start struct<entry:string>, "
              "err struct<error_code:string>, item string, ts bigint")
    parsed = values.compute_once(out, "stream", m=F.from_json("value", schema))

    def item(stream: str):
        return F.when(F.col("stream") == stream, F.col("m.item")).alias(f"{stream}_item")

    return parsed.select("stream", "m.common.*", "m.page.page_id", "m.start.entry", "m.err.error_code", item("display"),
                         item("action"), "m.ts")


@query("log_split_counts", f"""
WITH {sql.EVENTS}
SELECT 'err' AS stream, count(*) AS n FROM ev WHERE event_type = 'error'
UNION ALL SELECT 'start', count(*) FROM ev WHERE event_type = 'signup'
UNION ALL SELECT 'display', CAST(sum(k % 3 + 1) AS BIGINT) FROM ev WHERE event_type = 'view'
UNION ALL SELECT 'action', count(*) FROM ev WHERE event_type = 'click'
UNION ALL SELECT 'page', count(*) FROM ev WHERE event_type <> 'signup'""")
def log_split_counts(spark, sf_dir):
    parsed = logs.parse(shapes.log_messages(shapes.events(spark, sf_dir)))
    return logs.tagged(parsed).groupBy("stream").agg(F.count(F.lit(1)).alias("n"))


@query("traffic_from_messages", f"""
WITH {sql.PAGES}, views AS (SELECT * FROM pg WHERE ch <> 'signup'), marked AS (
  SELECT *, row_number() OVER (PARTITION BY mid, CAST(et AS DATE) ORDER BY et, vc, ch, ar, is_new) = 1 AS new_day,
         row_number() OVER (PARTITION BY sid ORDER BY et, vc, ch, ar, is_new) = 1 AS new_session
  FROM views
)
SELECT {sql.window('1 day')}, '{AS_OF}' AS cur_date, vc, ch, ar, is_new,
       count(*) FILTER (WHERE new_day) AS uv_ct, count(*) FILTER (WHERE new_session) AS sv_ct, count(*) AS pv_ct,
       CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM marked GROUP BY ALL""")
def traffic_from_messages(spark, sf_dir):
    """Raw JSON logs, split, the page stream parsed again and summarised."""
    parsed = logs.parse(shapes.log_messages(shapes.events(spark, sf_dir)))
    return dws.traffic(session.settled(logs.pages(logs.split(parsed)["page"])), "1 day", as_of=AS_OF)


# -- routing ---------------------------------------------------------------------------------------------------------

def fact_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("user_info", "insert", "dwd_user_register", "id,name"),
            ("comment_info", "insert", "dwd_comment", "id,user_id,appraise,create_time"),
            ("order_info", "update", "dwd_order_moves", "id,order_status"),
        ],
        schemas.FACT_CONFIG,
    )


def dim_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("user_info", "dim_user_info", "id,name,segment", "info", "id"),
            ("comment_info", "dim_comment", "id,comment_txt", "info", "id"),
        ],
        schemas.DIM_CONFIG,
    )


def routed_topic(spark, sf_dir) -> DataFrame:
    customer, orders = _tables(spark, sf_dir, "customer", "orders")
    return shapes.user_info(customer).unionByName(shapes.comment_info(orders)).unionByName(_orders(spark, sf_dir))


@query("fact_routes", """
SELECT 'dwd_user_register' AS sink_table, 1700000000 + c_custkey AS ts,
       '{"id":"' || c_custkey || '","name":"' || c_name || '"}' AS value FROM customer
UNION ALL SELECT 'dwd_user_register', 1730000000 + c_custkey, '{"id":"' || c_custkey || '","name":"back"}'
FROM customer WHERE c_custkey % 14 = 0
UNION ALL SELECT 'dwd_comment', CAST(epoch(o_orderdate) AS BIGINT), '{"id":"' || o_orderkey || '","user_id":"'
  || o_custkey || '","appraise":"' || substring(o_orderpriority, 1, 1) || '","create_time":"'
  || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' FROM orders
UNION ALL SELECT 'dwd_order_moves', CAST(epoch(o_orderdate) AS BIGINT) + 3600,
  '{"id":"' || o_orderkey || '","order_status":"' || s || '"}'
FROM orders JOIN (VALUES ('P', '1003'), ('F', '1005'), ('F', '1006')) m(f, s) ON f = o_orderstatus""")
def fact_routes(spark, sf_dir):
    routed = dwd.base_db(routed_topic(spark, sf_dir), fact_config(spark))
    return routed.select("sink_table", "ts", F.to_json("data").alias("value"))


@query("dim_changes", """
SELECT 'dim_user_info' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key, kind AS type,
       1700000000 + c_custkey + later AS ts
FROM customer JOIN (VALUES ('bootstrap-insert', 0, 1), ('update', 10000000, 3), ('delete', 20000000, 7),
                           ('insert', 30000000, 14)) m(kind, later, step) ON c_custkey % step = 0
UNION ALL SELECT 'dim_comment', CAST(o_orderkey AS VARCHAR), 'insert', CAST(epoch(o_orderdate) AS BIGINT) FROM orders""")
def dim_changes(spark, sf_dir):
    return dim.changes(routed_topic(spark, sf_dir), dim_config(spark), shapes.DATABASE).drop("data")


@query("dim_snapshot", """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 14 = 0 THEN 'back' ELSE c_name END AS name,
       CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment
FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 14 = 0""")
def dim_snapshot(spark, sf_dir):
    changes = dim.changes(routed_topic(spark, sf_dir), dim_config(spark), shapes.DATABASE)
    return dim.snapshot(changes.filter(F.col("sink_table") == "dim_user_info"), ["id", "name", "segment"])


@query("register_topic", f"""
SELECT {sql.window('1 hour', "date_trunc('second', ts)")}, '{AS_OF}' AS cur_date, count(*) AS register_ct
FROM events WHERE event_type = 'signup' GROUP BY ALL""")
def register_topic(spark, sf_dir):
    """Users inserted, routed by configuration to the register topic, and counted."""
    events = shapes.events(spark, sf_dir)
    users = shapes.union(shapes.record(
        events.filter("event_type = 'signup'"), "user_info", "insert", shapes.seconds(F.col("ts")),
        {"id": F.col("user_id"), "create_time": shapes.date_time(F.col("ts")), "login_name": F.lit("x")}))
    topic = users.unionByName(shapes.cart_info(events))
    config = spark.createDataFrame(
        [("user_info", "insert", "dwd_user_register", "id,create_time"), ("cart_info", "insert", "dwd_carts", "id")],
        schemas.FACT_CONFIG)
    registered = dwd.base_db(topic, config).filter(F.col("sink_table") == "dwd_user_register")
    return dws.registrations(registered.select(F.col("data")["create_time"].alias("create_time")), "1 hour",
                             as_of=AS_OF)


# Moments at which the configuration changes, in epoch seconds.
TURNS = (801_964_800, 852_076_800)


def config_history(spark: SparkSession) -> DataFrame:
    """The comment route changes its table and columns, then goes; a route for order moves is added."""
    start = fact_config(spark).filter("source_table <> 'order_info'")
    comment = ("comment_info", "insert", "dwd_comment", "id")
    changes = [
        ("u", comment, ("comment_info", "insert", "dwd_comment_new", "id,appraise"), TURNS[0] * 1000),
        ("c", None, ("order_info", "update", "dwd_order_moves", "id"), TURNS[0] * 1000),
        ("d", comment, None, TURNS[1] * 1000),
    ]
    kind = schemas.config_change(schemas.FACT_CONFIG).add("ts_ms", "long")
    return routing.config_versions(start, spark.createDataFrame(changes, kind), ("table", "type"))


CONFIG_AS_OF = f"""
SELECT 'dwd_user_register' AS sink_table, 1700000000 + c_custkey AS ts,
       '{{"id":"' || c_custkey || '","name":"' || c_name || '"}}' AS value FROM customer
UNION ALL SELECT 'dwd_user_register', 1730000000 + c_custkey, '{{"id":"' || c_custkey || '","name":"back"}}'
FROM customer WHERE c_custkey % 14 = 0
UNION ALL SELECT 'dwd_comment', CAST(epoch(o_orderdate) AS BIGINT), '{{"id":"' || o_orderkey || '","user_id":"'
  || o_custkey || '","appraise":"' || substring(o_orderpriority, 1, 1) || '","create_time":"'
  || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}}' FROM orders WHERE epoch(o_orderdate) < {TURNS[0]}
UNION ALL SELECT 'dwd_comment_new', CAST(epoch(o_orderdate) AS BIGINT), '{{"id":"' || o_orderkey || '","appraise":"'
  || substring(o_orderpriority, 1, 1) || '"}}' FROM orders WHERE epoch(o_orderdate) >= {TURNS[0]} AND epoch(o_orderdate) < {TURNS[1]}
UNION ALL SELECT 'dwd_order_moves', CAST(epoch(o_orderdate) AS BIGINT) + 3600, '{{"id":"' || o_orderkey || '"}}'
FROM orders JOIN (VALUES ('P'), ('F'), ('F')) m(f) ON f = o_orderstatus WHERE epoch(o_orderdate) + 3600 >= {TURNS[0]}"""


@query("config_as_of", CONFIG_AS_OF)
def config_as_of(spark, sf_dir):
    """A replay over two changes of the configuration."""
    routed = dwd.base_db(routed_topic(spark, sf_dir), config_history(spark))
    return routed.select("sink_table", "ts", F.to_json("data").alias("value"))
