"""Summary tables and reports on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import session
from ..operators import keywords, reports, skew
from ..plans import dws
from . import shapes, sql
from .registry import AS_OF, query

_DAY, _HOUR = "1 day", "1 hour"


def _pages(spark, sf_dir):
    return shapes.pages(shapes.events(spark, sf_dir))


def _traffic_sql(size: str) -> str:
    return f"""
WITH {sql.PAGES}, marked AS (
  SELECT *, row_number() OVER (PARTITION BY mid, CAST(et AS DATE) ORDER BY et, vc, ch, ar, is_new) = 1 AS new_day,
         row_number() OVER (PARTITION BY sid ORDER BY et, vc, ch, ar, is_new) = 1 AS new_session
  FROM pg
)
SELECT {sql.window(size)}, '{AS_OF}' AS cur_date, vc, ch, ar, is_new,
       count(*) FILTER (WHERE new_day) AS uv_ct, count(*) FILTER (WHERE new_session) AS sv_ct, count(*) AS pv_ct,
       CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM marked GROUP BY ALL"""


@query("traffic_window", _traffic_sql(_HOUR))
def traffic_window(spark, sf_dir):
    return dws.traffic(_pages(spark, sf_dir), _HOUR, as_of=AS_OF)


@query("traffic_window_5s", _traffic_sql("5 seconds"))
def traffic_window_5s(spark, sf_dir):
    return dws.traffic(_pages(spark, sf_dir), as_of=AS_OF)


@query("home_detail_uv", f"""
WITH {sql.PAGES}, seen AS (
  SELECT *, CAST(et AS DATE) AS d, lag(CAST(et AS DATE)) OVER (PARTITION BY mid, page_id ORDER BY et) AS last_d
  FROM pg WHERE page_id IN ('home', 'good_detail')
)
SELECT {sql.window(_HOUR)}, '{AS_OF}' AS cur_date,
       count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct,
       count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct
FROM seen WHERE d IS DISTINCT FROM last_d GROUP BY ALL""")
def home_detail_uv(spark, sf_dir):
    return dws.home_detail(_pages(spark, sf_dir), _HOUR, as_of=AS_OF)


def _logins_sql(days: int) -> str:
    return f"""
WITH {sql.PAGES}, seen AS (
  SELECT *, CAST(et AS DATE) AS d, lag(CAST(et AS DATE)) OVER (PARTITION BY uid ORDER BY et) AS last_d
  FROM pg WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
)
SELECT {sql.window(_DAY)}, '{AS_OF}' AS cur_date,
       count(*) FILTER (WHERE date_diff('day', last_d, d) > {days}) AS back_ct, count(*) AS uu_ct
FROM seen WHERE d IS DISTINCT FROM last_d GROUP BY ALL"""


@query("logins", _logins_sql(7))
def logins(spark, sf_dir):
    return dws.logins(_pages(spark, sf_dir), _DAY, as_of=AS_OF)


@query("logins_back_after_2_days", _logins_sql(2))
def logins_back_after_2_days(spark, sf_dir):
    return dws.logins(_pages(spark, sf_dir), _DAY, as_of=AS_OF, days=2)


@query("registers", f"""
SELECT {sql.window(_HOUR, "date_trunc('second', ts)")}, '{AS_OF}' AS cur_date, count(*) AS register_ct
FROM events WHERE event_type = 'signup' GROUP BY ALL""")
def registers(spark, sf_dir):
    users = shapes.table(spark, sf_dir, "events").filter("event_type = 'signup'")
    return dws.registrations(users.select(shapes.date_time(F.col("ts")).alias("create_time")), _HOUR, as_of=AS_OF)


@query("cart_users", f"""
WITH seen AS (
  SELECT user_id, date_trunc('second', ts) AS et, CAST(ts AS DATE) AS d,
         lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts) AS last_d
  FROM events WHERE event_type = 'click'
)
SELECT {sql.window(_HOUR)}, '{AS_OF}' AS cur_date, count(*) AS cart_add_uu_ct
FROM seen WHERE d IS DISTINCT FROM last_d GROUP BY ALL""")
def cart_users(spark, sf_dir):
    clicks = shapes.table(spark, sf_dir, "events").filter("event_type = 'click'")
    carts = clicks.select(shapes.text("user_id").alias("user_id"), shapes.seconds(F.col("ts")).alias("ts"))
    return dws.cart_users(carts, _HOUR, as_of=AS_OF)


def _users_sql(source: str, size: str, unique: str, new: str) -> str:
    return f"""
WITH seen AS (
  SELECT user_id, et, CAST(et AS DATE) AS d, lag(CAST(et AS DATE)) OVER (PARTITION BY user_id ORDER BY et) AS last_d
  FROM ({source})
)
SELECT {sql.window(size)}, '{AS_OF}' AS cur_date, count(*) AS {unique}, count(*) FILTER (WHERE last_d IS NULL) AS {new}
FROM seen WHERE d IS DISTINCT FROM last_d GROUP BY ALL"""


@query("payment_users", _users_sql(
    "SELECT user_id, date_trunc('second', ts) AS et FROM events WHERE event_type = 'purchase'", _HOUR,
    "payment_suc_unique_user_count", "payment_suc_new_user_count"))
def payment_users(spark, sf_dir):
    bought = shapes.table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    paid = bought.select(shapes.text("user_id").alias("user_id"), shapes.seconds(F.col("ts")).alias("ts"))
    return dws.payment_users(paid, _HOUR, as_of=AS_OF)


@query("order_users", _users_sql("SELECT o_custkey AS user_id, o_orderdate AS et FROM orders", _DAY,
                                 "order_unique_user_count", "order_new_user_count"))
def order_users(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders")
    placed = orders.select(shapes.text("o_custkey").alias("user_id"), shapes.seconds(F.col("o_orderdate")).alias("ts"))
    return dws.order_users(placed, _DAY, as_of=AS_OF)


_TOKENS = "unnest(list_distinct(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+')))"


@query("keyword_count", f"""
WITH {sql.PAGES}, words AS (
  SELECT et, {_TOKENS.format('item')} AS keyword
  FROM pg WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL
)
SELECT strftime(time_bucket(INTERVAL '1 hour', et), '{sql.STAMP}') AS window_start,
       strftime(time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour', '{sql.STAMP}') AS window_end,
       '{AS_OF}' AS cur_date, keyword, count(*) AS keyword_count
FROM words WHERE keyword <> '' GROUP BY ALL""")
def keyword_count(spark, sf_dir):
    return dws.keyword_count(_pages(spark, sf_dir), _HOUR, as_of=AS_OF)


@query("keyword_count_sql", f"""
WITH {sql.PAGES}, words AS (
  SELECT et, {_TOKENS.format('item')} AS keyword
  FROM pg WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL
)
SELECT strftime(time_bucket(INTERVAL '1 hour', et), '{sql.STAMP}') AS window_start, keyword, count(*) AS keyword_count
FROM words WHERE keyword <> '' GROUP BY ALL""")
def keyword_count_sql(spark, sf_dir):
    """The same as plain SQL with the registered table function and a window."""
    keywords.register(spark)
    keywords.searches(_pages(spark, sf_dir)).createOrReplaceTempView("searched")
    return spark.sql("""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS window_start, keyword, count(*) AS keyword_count
        FROM (SELECT timestamp_millis(ts) AS et, item FROM searched), LATERAL kw_split(item)
        GROUP BY window(et, '1 hour'), keyword
    """)


@query("keyword_count_texts", f"""
WITH words AS (
  SELECT make_timestamp(doc_id * 60000000) AS et, {_TOKENS.format('text')} AS keyword
  FROM documents WHERE text IS NOT NULL
)
SELECT strftime(time_bucket(INTERVAL '1 hour', et), '{sql.STAMP}') AS window_start,
       strftime(time_bucket(INTERVAL '1 hour', et) + INTERVAL '1 hour', '{sql.STAMP}') AS window_end,
       '{AS_OF}' AS cur_date, keyword, count(*) AS keyword_count
FROM words WHERE keyword <> '' GROUP BY ALL""")
def keyword_count_texts(spark, sf_dir):
    """Whole document texts as search texts, one per minute."""
    docs = shapes.table(spark, sf_dir, "documents")
    searched = docs.select(
        F.lit("search").alias("last_page_id"), F.lit("keyword").alias("item_type"), F.col("text").alias("item"),
        (F.col("doc_id") * 60_000).alias("ts"),
    )
    return dws.keyword_count(searched, _HOUR, as_of=AS_OF)


_SKU_COLUMNS = ("trademark_id, trademark_name, category1_id, category1_name, category2_id, category2_name, "
                "category3_id, category3_name")


@query("sku_orders", f"""
WITH {sql.VERSIONS}, {sql.SKU_DIMS}, typed AS (
  SELECT *, CAST(original_raw AS DECIMAL(20,2)) AS original_amount FROM ver
), changed AS (
  SELECT sku_id, et,
         {', '.join(f"{m} - coalesce(lag({m}) OVER w, 0) AS {m}" for m in (
             'original_amount', 'activity_reduce_amount', 'coupon_reduce_amount', 'order_amount'))}
  FROM typed WINDOW w AS (PARTITION BY id ORDER BY et, sku_id, original_amount, activity_reduce_amount,
                          coupon_reduce_amount, order_amount)
), summed AS (
  SELECT {sql.window(_DAY)}, sku_id, sum(original_amount) AS o, sum(activity_reduce_amount) AS a,
         sum(coupon_reduce_amount) AS c, sum(order_amount) AS t
  FROM changed GROUP BY ALL
)
SELECT stt, edt, '{AS_OF}' AS cur_date, {_SKU_COLUMNS}, sku_id, 'sku ' || sku_id AS sku_name, spu_id, spu_name,
       CAST(o AS DECIMAL(20,2)) AS original_amount, CAST(a AS DECIMAL(20,2)) AS activity_reduce_amount,
       CAST(c AS DECIMAL(20,2)) AS coupon_reduce_amount, CAST(t AS DECIMAL(20,2)) AS order_amount
FROM summed LEFT JOIN sku USING (sku_id)""")
def sku_orders(spark, sf_dir):
    lines = shapes.line_versions(shapes.table(spark, sf_dir, "lineitem"))
    return dws.sku_orders(lines, shapes.dims(shapes.table(spark, sf_dir, "part")), ("et",), _DAY, as_of=AS_OF)


PROVINCE_SQL = f"""
WITH {sql.VERSIONS}, {sql.PLACED}, changed AS (
  SELECT province_id, order_id, et, order_amount - coalesce(lag(order_amount) OVER (
           PARTITION BY id ORDER BY et, province_id, order_amount), 0) AS order_amount
  FROM ver JOIN od USING (order_id)
), summed AS (
  SELECT {sql.window(_DAY)}, province_id, count(DISTINCT order_id) AS order_count, sum(order_amount) AS amount
  FROM changed GROUP BY ALL
)
SELECT stt, edt, '{AS_OF}' AS cur_date, province_id, n_name AS province_name, order_count,
       CAST(amount AS DECIMAL(20,2)) AS order_amount
FROM summed LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)"""


@query("province_orders", PROVINCE_SQL)
def province_orders(spark, sf_dir):
    lines = shapes.line_versions(shapes.table(spark, sf_dir, "lineitem"))
    details = shapes.with_province(lines, shapes.table(spark, sf_dir, "orders"), shapes.table(spark, sf_dir, "customer"))
    # Looked for before the join: the line ids come from the lines alone.
    heavy = skew.heavy_keys(lines, ["id"])
    return dws.province_orders(details, shapes.provinces(shapes.table(spark, sf_dir, "nation")), ("et",), _DAY, as_of=AS_OF,
                               heavy=heavy)


@query("province_orders_by_arrival", f"""
WITH {sql.VERSIONS}, {sql.PLACED}, seen AS (
  SELECT ver.*, n, CASE n WHEN 1 THEN order_amount ELSE order_amount - 1 END AS now
  FROM ver, (VALUES (1), (2)) AS copies(n)
), changed AS (
  SELECT province_id, order_id, et, now - coalesce(lag(now) OVER (
           PARTITION BY id ORDER BY et, n, province_id, now), 0) AS order_amount
  FROM seen JOIN od USING (order_id)
), summed AS (
  SELECT {sql.window(_DAY)}, province_id, count(DISTINCT order_id) AS order_count, sum(order_amount) AS amount
  FROM changed GROUP BY ALL
)
SELECT stt, edt, '{AS_OF}' AS cur_date, province_id, n_name AS province_name, order_count,
       CAST(amount AS DECIMAL(20,2)) AS order_amount
FROM summed LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)""")
def province_orders_by_arrival(spark, sf_dir):
    """Every line is corrected to a smaller amount within its second; only the arrival column tells which came last."""
    lines = shapes.line_versions(shapes.table(spark, sf_dir, "lineitem"))
    amount = F.col("split_total_amount").cast("decimal(20,2)")
    both = lines.withColumn("arrival", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "split_total_amount", F.when(F.col("arrival") == 1, amount).otherwise(amount - 1).cast("string"))
    details = shapes.with_province(both, shapes.table(spark, sf_dir, "orders"), shapes.table(spark, sf_dir, "customer"))
    provinces = shapes.provinces(shapes.table(spark, sf_dir, "nation"))
    # Looked for before the join, as above, among both versions of each line.
    heavy = skew.heavy_keys(both, ["id"])
    return dws.province_orders(details, provinces, ("et", "arrival"), _DAY, as_of=AS_OF, heavy=heavy)


@query("refund_by_brand_type_user", f"""
WITH {sql.SKU_DIMS}, keyed AS (
  SELECT l_shipdate AS et, trademark_id, category3_id, CAST(l_suppkey AS VARCHAR) AS user_id, l_orderkey
  FROM lineitem LEFT JOIN sku ON sku_id = CAST(l_partkey AS VARCHAR) WHERE l_returnflag = 'R'
), counted AS (
  SELECT {sql.window(_DAY)}, trademark_id, category3_id, user_id, count(DISTINCT l_orderkey) AS refund_count
  FROM keyed GROUP BY ALL
), names AS (
  SELECT DISTINCT category3_id, category3_name, category2_id, category2_name, category1_id, category1_name FROM sku
), brands AS (SELECT DISTINCT trademark_id, trademark_name FROM sku)
SELECT stt, edt, '{AS_OF}' AS cur_date, {_SKU_COLUMNS}, user_id, refund_count
FROM counted LEFT JOIN names USING (category3_id) LEFT JOIN brands USING (trademark_id)""")
def refund_by_brand_type_user(spark, sf_dir):
    returned = shapes.returned_lines(shapes.table(spark, sf_dir, "lineitem"))
    return dws.refunds(returned, shapes.dims(shapes.table(spark, sf_dir, "part")), _DAY, as_of=AS_OF)


_SHOPS_CTE = f"""shop AS (
  SELECT {sql.window(_DAY, 'l_shipdate')}, '{AS_OF}' AS cur_date, CAST(sum({sql.TOTAL}) AS DECIMAL(20,2)) AS amount,
         CAST(l_suppkey AS VARCHAR) AS shop_id
  FROM lineitem GROUP BY ALL
), named AS (
  SELECT stt, edt, cur_date, amount, shop_id, s_name AS shop_name
  FROM shop LEFT JOIN supplier ON shop_id = CAST(s_suppkey AS VARCHAR)
)"""


def _shops(spark, sf_dir):
    """The supplier of a line is its shop."""
    lines = shapes.line_versions(shapes.table(spark, sf_dir, "lineitem"))
    return dws.shop_amounts(lines, shapes.shops(shapes.table(spark, sf_dir, "supplier")), _DAY, as_of=AS_OF,
                            shop=F.col("supplier_id"))


@query("shop_top", f"WITH {_SHOPS_CTE} SELECT * FROM named")
def shop_top(spark, sf_dir):
    return _shops(spark, sf_dir)


@query("shop_ranked", f"""WITH {_SHOPS_CTE}
SELECT *, row_number() OVER (PARTITION BY stt, edt ORDER BY amount DESC, shop_id) AS num FROM named""")
def shop_ranked(spark, sf_dir):
    return reports.ranked(session.settled(_shops(spark, sf_dir)), "amount")


_TOP_DAY = "1999-08-19 00:00:00"


@query("shop_top_of_window", f"""WITH {_SHOPS_CTE}
SELECT *, CAST(row_number() OVER (ORDER BY amount DESC, shop_id) AS INTEGER) AS num FROM named WHERE stt = '{_TOP_DAY}'
ORDER BY amount DESC, shop_id LIMIT 10""")
def shop_top_of_window(spark, sf_dir):
    return reports.top_n(_shops(spark, sf_dir).filter(F.col("stt") == _TOP_DAY), "amount")


@query("shop_top_per_window", f"""WITH {_SHOPS_CTE}
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY stt, edt ORDER BY amount DESC, shop_id) AS INTEGER) AS num FROM named
) WHERE num <= 10""")
def shop_top_per_window(spark, sf_dir):
    return reports.top_n_per_window(_shops(spark, sf_dir), "amount")


_REPORT_DAY = "2024-01-15"
_WORDS_CTE = sql.PAGES + f""", words AS (
  SELECT strftime(et, '%Y-%m-%d') AS cur_date, {_TOKENS.format('item')} AS keyword
  FROM pg WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword'
), word_count AS (SELECT cur_date, keyword, count(*) AS keyword_count FROM words WHERE keyword <> '' GROUP BY ALL)"""


def _word_counts(spark, sf_dir):
    """The keyword table with each day's rows under that day."""
    counted = dws.keyword_count(_pages(spark, sf_dir), _DAY)
    return counted.select(F.substring("window_start", 1, 10).alias("cur_date"), "keyword", "keyword_count")


@query("day_report", f"WITH {_WORDS_CTE} SELECT * FROM word_count WHERE cur_date = '{_REPORT_DAY}'")
def day_report(spark, sf_dir):
    return reports.of_day(_word_counts(spark, sf_dir), _REPORT_DAY)


@query("word_list", f"""WITH {_WORDS_CTE}
SELECT keyword AS name, keyword_count AS value FROM word_count WHERE cur_date = '{_REPORT_DAY}'""")
def word_list(spark, sf_dir):
    return reports.name_values(_word_counts(spark, sf_dir), "keyword", "keyword_count", _REPORT_DAY)


@query("day_total", f"""SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(30,2)) AS total
FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') = '1998-06-10'""")
def day_total(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("cur_date"), shapes.decimal("o_totalprice", 20).alias("value"))
    return reports.total(orders, "value", "1998-06-10")


@query("map_list", """SELECT n_name AS name, count(*) AS value
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def map_list(spark, sf_dir):
    customer, nation = shapes.table(spark, sf_dir, "customer"), shapes.table(spark, sf_dir, "nation")
    counted = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    named = counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.name_values(named, "n_name", "customers")


@query("envelope", f"""WITH {_SHOPS_CTE}, top AS (
  SELECT stt, edt, shop_name, amount, CAST(row_number() OVER (ORDER BY amount DESC, shop_id) AS INTEGER) AS num
  FROM named WHERE stt = '{_TOP_DAY}' ORDER BY num LIMIT 10
)
SELECT '{{"status":0,"msg":"","data":{{"columns":[{{"name":"start","id":"stt"}},{{"name":"end","id":"edt"}},'
    || '{{"name":"shop","id":"shop_name"}},{{"name":"amount","id":"amount"}},{{"name":"rank","id":"num"}}],"rows":['
    || string_agg('{{"stt":"' || stt || '","edt":"' || edt || '","shop_name":"' || shop_name || '","amount":' || amount
                  || ',"num":' || num || '}}', ',' ORDER BY num) || ']}}}}' AS value
FROM top""")
def envelope(spark, sf_dir):
    best = reports.top_n(_shops(spark, sf_dir).filter(F.col("stt") == _TOP_DAY), "amount")
    return reports.envelope(
        best.select("stt", "edt", "shop_name", "amount", "num"), order="num",
        columns={"stt": "start", "edt": "end", "shop_name": "shop", "amount": "amount", "num": "rank"},
    )
