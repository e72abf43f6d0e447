"""Single operators and functions on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas, session
from ..functions import naming, times, values
from ..operators import bitmaps, cdc, enrich, facts, joins, keywords, logs, reports, routing, skew, state, versions
from ..sinks import topics
from . import shapes, sql
from .detail_queries import REPAIRED
from .registry import query


def _flags(spark, sf_dir) -> DataFrame:
    return shapes.pages(shapes.events(spark, sf_dir)).select("mid", "ts", "is_new").withColumn(
        "et", F.timestamp_millis("ts"))


_REPAIR_SQL = f"WITH {REPAIRED} SELECT mid, ts, is_new FROM fixed"


@query("is_new_repair", _REPAIR_SQL)
def is_new_repair(spark, sf_dir):
    return state.repair_is_new(_flags(spark, sf_dir), "mid", "et", "is_new", ("ts",)).drop("et")


@query("is_new_repair_split", _REPAIR_SQL)
def is_new_repair_split(spark, sf_dir):
    """The same with every visitor above 50 records treated as heavy."""
    rows = _flags(spark, sf_dir)
    heavy = skew.heavy_keys(rows, ["mid"], limit=50)
    return state.repair_is_new(rows, "mid", "et", "is_new", ("ts",), heavy=heavy).drop("et")


@query("first_of_day", f"""
WITH {sql.EVENTS}
SELECT event_id, user_id FROM (
  SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts) AS last_d FROM ev
) WHERE CAST(ts AS DATE) IS DISTINCT FROM last_d""")
def first_of_day(spark, sf_dir):
    rows = shapes.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return state.first_of_day(rows, ["user_id"], "ts", ("event_id",)).drop("ts")


@query("first_ever", "SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def first_ever(spark, sf_dir):
    rows = shapes.table(spark, sf_dir, "events").withColumn("key", F.concat_ws("-", "event_type", "user_id"))
    return state.first_ever(rows, "key", "ts", ("event_id",)).select("event_type", "user_id", "event_id")


_ARRIVAL_SQL = f"""
WITH {sql.EVENTS}
SELECT event_id, user_id FROM (
  SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY k, event_id) AS last_d FROM ev
) WHERE CAST(ts AS DATE) IS DISTINCT FROM last_d"""


def _arrivals(spark, sf_dir) -> DataFrame:
    """Events that arrive by k, so that days come back."""
    return shapes.events(spark, sf_dir).select("event_id", "user_id", "ts", "k")


@query("day_changes", _ARRIVAL_SQL)
def day_changes(spark, sf_dir):
    return state.day_changes(_arrivals(spark, sf_dir), "user_id", "ts", ["k", "event_id"]).select("event_id", "user_id")


@query("day_changes_split", _ARRIVAL_SQL)
def day_changes_split(spark, sf_dir):
    """The same with every user above 50 records treated as heavy."""
    rows = _arrivals(spark, sf_dir)
    heavy = skew.heavy_keys(rows, ["user_id"], limit=50)
    changed = state.day_changes(rows, "user_id", "ts", ["k", "event_id"], heavy=heavy)
    return changed.select("event_id", "user_id")


@query("latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n FROM lineitem
) WHERE n = 1""")
def latest(spark, sf_dir):
    lines = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return state.latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


_DELTA_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       CAST(p - coalesce(lag(p) OVER w, 0) AS DECIMAL(20,2)) AS price,
       CAST(q - coalesce(lag(q) OVER w, 0) AS DECIMAL(20,2)) AS quantity
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(20,2)) AS p, CAST(l_quantity AS DECIMAL(20,2)) AS q FROM lineitem)
WINDOW w AS (PARTITION BY {key} ORDER BY l_shipdate, l_partkey, l_suppkey, l_orderkey, l_linenumber, p)"""


def _measured(spark, sf_dir) -> DataFrame:
    return shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        shapes.decimal("l_extendedprice", 20).alias("price"), shapes.decimal("l_quantity", 20).alias("quantity"))


_DELTA_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "price"]


@query("delta", _DELTA_SQL.format(key="l_orderkey, l_linenumber"))
def delta(spark, sf_dir):
    return state.delta(_measured(spark, sf_dir), ["l_orderkey", "l_linenumber"], _DELTA_ORDER, ["price", "quantity"])


@query("delta_split", _DELTA_SQL.format(key="l_linenumber"))
def delta_split(spark, sf_dir):
    """A key per line number, a seventh of all rows each, cut into chunks of about 500 rows."""
    rows = _measured(spark, sf_dir)
    heavy = skew.heavy_keys(rows, ["l_linenumber"], limit=500)
    return state.delta(rows, ["l_linenumber"], _DELTA_ORDER, ["price", "quantity"], heavy)


@query("payments_interval", """
SELECT s.event_id AS signup_id, p.event_id AS purchase_id, s.user_id
FROM events s JOIN events p ON s.user_id = p.user_id
  AND p.ts BETWEEN s.ts - INTERVAL '15 seconds' AND s.ts + INTERVAL '1 hour'
WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""")
def payments_interval(spark, sf_dir):
    rows = shapes.table(spark, sf_dir, "events")
    signups = rows.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "user_id",
                                                         F.col("ts").alias("st"))
    bought = rows.filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id",
                                                           F.col("ts").alias("pt"))
    pairs = joins.interval(signups, bought, ["user_id"], "st", "pt", "15 seconds", "1 hour")
    return pairs.select("signup_id", "purchase_id", "user_id")


@query("sku_enrichment", f"""
WITH {sql.SKU_DIMS}
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS sku_id, trademark_id, trademark_name, category1_id,
       category1_name, category2_id, category2_name, category3_id, category3_name, spu_id, spu_name
FROM lineitem LEFT JOIN sku ON sku_id = CAST(l_partkey AS VARCHAR)""")
def sku_enrichment(spark, sf_dir):
    lines = shapes.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                           shapes.text("l_partkey").alias("sku_id"))
    return enrich.sku_hierarchy(lines, shapes.dims(shapes.table(spark, sf_dir, "part")))


@query("split_join", """
SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey <> 3""")
def split_join(spark, sf_dir):
    """Suppliers above 300 lines are treated as heavy."""
    lines = shapes.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    supplier = shapes.table(spark, sf_dir, "supplier").filter("s_suppkey <> 3").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name")
    heavy = skew.heavy_keys(lines, ["l_suppkey"], limit=300)
    return skew.join(lines, supplier, ["l_suppkey"], "left", heavy=heavy).drop("l_suppkey")


@query("split_numbers", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_extendedprice AS DECIMAL(20,2)) DESC, l_orderkey,
                          l_linenumber, l_partkey, l_suppkey) AS num
FROM lineitem""")
def split_numbers(spark, sf_dir):
    """A third of all rows per key, numbered in ranges of about 2,000 rows."""
    rows = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        shapes.decimal("l_extendedprice", 20).alias("price"))
    heavy = skew.heavy_keys(rows, ["l_returnflag"], limit=2000)
    ties = [F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return skew.numbered(rows, ["l_returnflag"], ties, "price", "num", heavy).drop("l_returnflag", "price")


@query("status_moves", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, s AS status, r AS rule FROM orders
JOIN (VALUES ('P', '1003', 'from unpaid'), ('F', '1005', 'from any'), ('F', '1006', 'from any')) m(f, s, r)
  ON f = o_orderstatus""")
def status_moves(spark, sf_dir):
    topic = shapes.order_info(shapes.table(spark, sf_dir, "orders"), shapes.table(spark, sf_dir, "customer"))

    def moves(to: str, from_: str | None, rule: str) -> DataFrame:
        rows = cdc.status_transition(topic, "order_info", "order_status", to, from_, database=shapes.DATABASE)
        return rows.select(F.col("data")["id"].alias("id"), F.lit(to).alias("status"), F.lit(rule).alias("rule"))

    return moves("1003", "1001", "from unpaid").unionByName(moves("1005", None, "from any")).unionByName(
        moves("1006", None, "from any"))


@query("change_filter", """
SELECT kind AS type, count(*) AS n FROM customer
JOIN (VALUES ('bootstrap-insert', 1), ('update', 3), ('insert', 14)) m(kind, step) ON c_custkey % step = 0 GROUP BY kind""")
def change_filter(spark, sf_dir):
    topic = shapes.user_info(shapes.table(spark, sf_dir, "customer"))
    return cdc.changes(topic, shapes.DATABASE, skip_types=("delete", *cdc.BOOTSTRAP_MARKS)).groupBy("type").agg(
        F.count(F.lit(1)).alias("n"))


@query("parse_change_records", """
SELECT 'user_info' AS "table", CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 1700000000 + c_custkey AS ts
FROM customer""")
def parse_change_records(spark, sf_dir):
    """Records written as JSON messages, mixed with unreadable ones, and parsed back."""
    rows = shapes.user_info(shapes.table(spark, sf_dir, "customer"))
    good = rows.select(F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value"))
    bad = rows.select(F.concat(F.lit('{"table": '), F.col("data")["id"]).alias("value"))
    parsed = cdc.parse(good.unionByName(bad))
    inserted = cdc.slice(parsed, "user_info", ["id", "name"], "table", "ts", types=("bootstrap-insert",))
    return inserted.select("table", "id", "name", "ts")


def _prune_sql(comment_keys: list[str], user_keys: list[str]) -> str:
    return f"""
SELECT 'comment_info' AS "table", CAST(o_orderkey AS VARCHAR) AS id, '{','.join(sorted(comment_keys))}' AS keys
FROM orders
UNION ALL SELECT 'user_info', CAST(c_custkey AS VARCHAR), '{','.join(sorted(user_keys))}'
FROM customer JOIN (VALUES (1), (14)) m(step) ON c_custkey % step = 0"""


def _pruned(spark, sf_dir, mode: str) -> DataFrame:
    rows = shapes.comment_info(shapes.table(spark, sf_dir, "orders")).unionByName(
        shapes.user_info(shapes.table(spark, sf_dir, "customer")))
    config = spark.createDataFrame(
        [("comment_info", "insert", "a", "user_id,comment_txt"), ("user_info", "insert", "b", "nation_id,name")],
        schemas.FACT_CONFIG)
    matched = routing.match(rows, config, by=("table", "type")).withColumn("id", F.col("data")["id"])
    kept = F.array_join(F.sort_array(F.map_keys("data")), ",")
    return routing.prune(matched, mode=mode).select("table", "id", kept.alias("keys"))


@query("prune_exact", _prune_sql(["user_id", "comment_txt"], ["name"]))
def prune_exact(spark, sf_dir):
    return _pruned(spark, sf_dir, "exact")


@query("prune_substring", _prune_sql(["id", "user_id", "comment_txt"], ["id", "name", "nation"]))
def prune_substring(spark, sf_dir):
    return _pruned(spark, sf_dir, "substring")


@query("config_upkeep", """
WITH fed AS (
  SELECT 'NATION_' || c_nationkey AS source_table, 'v' || c_custkey AS sink_table, c_custkey % 4 = 0 AS gone, c_custkey
  FROM customer
), last AS (SELECT source_table, arg_max(sink_table, c_custkey) AS sink_table, arg_max(gone, c_custkey) AS gone
            FROM fed GROUP BY source_table)
SELECT n_name AS source_table, coalesce(sink_table, 'v0') AS sink_table
FROM nation LEFT JOIN last ON source_table = n_name WHERE NOT coalesce(gone, FALSE)""")
def config_upkeep(spark, sf_dir):
    """Nations as the configuration, customers as its change feed."""
    snapshot = shapes.table(spark, sf_dir, "nation").select(F.col("n_name").alias("source_table"),
                                                           F.lit("v0").alias("sink_table"))
    customer = shapes.table(spark, sf_dir, "customer")
    row = F.struct(F.concat(F.lit("NATION_"), shapes.text("c_nationkey")).alias("source_table"),
                   F.concat(F.lit("v"), shapes.text("c_custkey")).alias("sink_table"))
    gone = F.col("c_custkey") % 4 == 0
    feed = customer.select(
        F.when(gone, "d").when(F.col("c_custkey") % 4 == 1, "c").otherwise("u").alias("op"),
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), F.col("c_custkey").alias("ts_ms"))
    return routing.latest_config(snapshot, feed)


@query("keyword_rows", f"""
WITH {sql.PAGES}
SELECT keyword, mid, ts FROM (
  SELECT mid, ts, unnest(list_distinct(string_split(lower(item), ' '))) AS keyword
  FROM pg WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword'
)""")
def keyword_rows(spark, sf_dir):
    found = keywords.searches(shapes.pages(shapes.events(spark, sf_dir)))
    return keywords.explode(found.select("mid", "ts", "item"), "item").drop("item")


@query("page_checks", f"""
WITH {sql.PAGES}
SELECT 'views' AS rule, count(*) AS n FROM pg
UNION ALL SELECT 'home and detail', count(*) FROM pg WHERE page_id IN ('home', 'good_detail')
UNION ALL SELECT 'logins', count(*) FROM pg WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
UNION ALL SELECT 'known users', count(*) FROM pg WHERE uid IS NOT NULL""")
def page_checks(spark, sf_dir):
    pages = shapes.pages(shapes.events(spark, sf_dir))
    checked = {
        "views": logs.page_views(pages), "home and detail": logs.page_views(pages, ("home", "good_detail")),
        "logins": logs.logins(pages), "known users": facts.require(pages, "uid", unit="ms"),
    }
    counted = [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
               for rule, rows in checked.items()]
    first, *rest = counted
    for part in rest:
        first = first.unionByName(part)
    return first


@query("time_functions", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS day,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS date_time, strftime(ts, '%Y%m%d') AS partition_day,
       strftime(ts + INTERVAL '8 hours', '%Y-%m-%d %H:%M:%S') AS date_time_east,
       CAST(floor(epoch(ts)) AS BIGINT) * 1000 - 8 * 3600000 AS parsed_east_ms,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) * 1000 AS midnight_ms,
       CAST(floor((epoch_us(ts) // 1000 - epoch_ms(TIMESTAMP '2023-12-31 12:00:00')) / 86400000) AS BIGINT) AS days_on
FROM events""")
def time_functions(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    date_time = times.ms_to_date_time(ms)
    return shapes.table(spark, sf_dir, "events").select(
        "event_id", ms.alias("ms"), times.ms_to_date(ms).alias("day"), date_time.alias("date_time"),
        times.ms_to_partition(ms).alias("partition_day"), times.ms_to_date_time(ms, "+08:00").alias("date_time_east"),
        times.date_time_to_ms(date_time, "+08:00").alias("parsed_east_ms"),
        times.date_to_ms(times.ms_to_date(ms)).alias("midnight_ms"),
        times.whole_days_between(F.col("ts").cast("timestamp"), times.parse(F.lit("2023-12-31 12:00:00"))).alias(
            "days_on"),
    )


@query("value_functions", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql.PRICE} AS amount, CAST(0 AS DECIMAL(20,2)) AS unreadable
FROM lineitem""")
def value_functions(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        values.money(shapes.money_text(shapes.decimal("l_extendedprice"))).alias("amount"),
        values.money(F.concat("l_returnflag", F.lit("?"))).alias("unreadable"),
    )


@query("json_rows", """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mkt_segment":"' || c_mktsegment || '"}' AS value
FROM customer""")
def json_rows(spark, sf_dir):
    """camelCase columns written as snake_case JSON, without the dropped column."""
    rows = shapes.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_mktsegment").alias("c_mkt_segment"), "c_acctbal")
    return topics.as_json(naming.to_camel(rows), drop=("cAcctbal",))


@query("report_lines", """
SELECT '{"status":0,"msg":"","data":{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}}' AS value
FROM nation""")
def report_lines(spark, sf_dir):
    return reports.lines(shapes.table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


@query("shop_buckets", "SELECT count(*) AS lines, 1 AS first_shop, 12 AS last_shop FROM lineitem")
def shop_buckets(spark, sf_dir):
    """Lines over hash shops: every line has one, from 1 to 12."""
    shop = values.bucket(F.col("id"), 12).cast("int")
    return shapes.line_versions(shapes.table(spark, sf_dir, "lineitem")).select(shop.alias("shop")).agg(
        F.count("shop").alias("lines"), F.min("shop").alias("first_shop"), F.max("shop").alias("last_shop"))


_AS_OF_SQL = """
SELECT event_id, last_id FROM (
  SELECT *, last_value(purchase_id IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY ts, kind, purchase_id ROWS UNBOUNDED PRECEDING) AS last_id
  FROM (SELECT event_id, user_id, ts, 1 AS kind, NULL AS purchase_id FROM events
        UNION ALL SELECT NULL, user_id, ts, 0, event_id FROM events WHERE event_type = 'purchase'))
WHERE kind = 1"""


def _last_purchase(spark, sf_dir, **how) -> DataFrame:
    events = shapes.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    found = versions.as_of(events, bought, ["user_id"], "ts", "ts", ("event_id",), **how)
    return found.select("event_id", F.col(versions.FOUND)["event_id"].alias("last_id"))


@query("as_of_intervals", _AS_OF_SQL)
def as_of_intervals(spark, sf_dir):
    """Each event with the last purchase of its user, purchases joined as intervals."""
    return _last_purchase(spark, sf_dir, few=True)


@query("as_of_ordered", _AS_OF_SQL)
def as_of_ordered(spark, sf_dir):
    """The same with purchases put between the events in order of time."""
    return _last_purchase(spark, sf_dir, few=False)


@query("as_of_split", _AS_OF_SQL)
def as_of_split(spark, sf_dir):
    """The same with every user above 20 events treated as heavy."""
    heavy = skew.heavy_keys(shapes.table(spark, sf_dir, "events"), ["user_id"], limit=20)
    return _last_purchase(spark, sf_dir, few=False, heavy=heavy)


_UV_SQL = f"""
SELECT {sql.window('1 day', 'ts')}, event_type, count(DISTINCT user_id) AS uv FROM events GROUP BY ALL"""


@query("uv_rolled_up", _UV_SQL)
def uv_rolled_up(spark, sf_dir):
    """Visitors per day from the bitmaps of 5 seconds, combined per hour and then per day."""
    events = shapes.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("et"), "user_id", "event_type")
    short = session.settled(bitmaps.construct(events, "et", "5 seconds", ["event_type"], "user_id"))
    hours = bitmaps.roll_up(short, "1 hour", ["event_type"])
    return bitmaps.counts(bitmaps.roll_up(hours, "1 day", ["event_type"]), ["event_type"], "uv")


@query("keyword_dictionary", """
SELECT a.p_partkey AS id, unnest(list_distinct(string_split(a.p_name || ' ' || b.p_name, ' '))) AS keyword
FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def keyword_dictionary(spark, sf_dir):
    """The names of two parts written together without blanks, cut by the dictionary of all words in names."""
    part = shapes.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    names = F.regexp_replace(F.concat("p_name", "next_name"), " ", "")
    after = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("next_name"))
    texts = part.join(after, "p_partkey").select(F.col("p_partkey").alias("id"), names.alias("text"))
    dictionary = part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return keywords.by_dictionary(texts, "text", dictionary).select("id", "keyword")
