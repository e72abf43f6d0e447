"""Building blocks of the checking SQL: the test tables in warehouse shapes, as DuckDB expressions."""

STAMP = "%Y-%m-%d %H:%M:%S"


def window(size: str, ts: str = "et") -> str:
    """stt and edt columns of the tumbling window around `ts`."""
    start = f"time_bucket(INTERVAL '{size}', {ts})"
    return f"strftime({start}, '{STAMP}') AS stt, strftime({start} + INTERVAL '{size}', '{STAMP}') AS edt"


def moment(ts: str) -> str:
    return f"strftime({ts}, '{STAMP}')"


EVENTS = """ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)"""

PAGES = EVENTS + """, pg AS (
  SELECT 'm' || user_id AS mid,
         CASE WHEN k % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         user_id || '-' || (k // 10) AS sid,
         'v' || (k % 3) AS vc, event_type AS ch, 'a' || (k % 5) AS ar,
         CASE WHEN k % 3 <> 0 THEN '1' ELSE '0' END AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
              WHEN 'purchase' THEN 'search' ELSE 'cart' END AS page_id,
         CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
         event_type || ' K' || (k % 7) || ' k' || (k % 4) AS item,
         CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CAST(round(value * 1000) AS BIGINT) AS during_time,
         epoch_us(ts) // 1000 AS ts, make_timestamp(epoch_us(ts) // 1000 * 1000) AS et
  FROM ev
)"""

LINE_ID = ("l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || "
           "strftime(l_shipdate, '%Y%m%d')")
_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISCOUNT = "CAST(l_discount AS DECIMAL(4,2))"
_TAX = "CAST(l_tax AS DECIMAL(4,2))"
TOTAL = f"CAST({_PRICE} * (CAST(1 AS DECIMAL(4,2)) - {_DISCOUNT}) AS DECIMAL(20,2))"
ACTIVITY = f"CAST({_PRICE} * {_DISCOUNT} AS DECIMAL(20,2))"
COUPON = f"CAST({_PRICE} * {_TAX} AS DECIMAL(20,2))"
PRICE = f"CAST({_PRICE} AS DECIMAL(20,2))"

# Order lines with the columns the detail jobs read, amounts as decimals.
LINES = f"""ln AS (
  SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         'sku ' || l_partkey AS sku_name, CAST({PRICE} AS VARCHAR) AS order_price,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num, {moment('l_shipdate')} AS create_time,
         CAST({TOTAL} AS VARCHAR) AS split_total_amount, CAST({ACTIVITY} AS VARCHAR) AS split_activity_amount,
         CAST({COUPON} AS VARCHAR) AS split_coupon_amount, CAST(epoch(l_shipdate) AS BIGINT) AS ts,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus, l_quantity,
         CASE WHEN l_discount >= 0.05 THEN CAST(l_suppkey AS VARCHAR) END AS activity_id,
         CASE WHEN l_discount >= 0.05 THEN CAST(l_linenumber AS VARCHAR) END AS activity_rule_id,
         CASE WHEN l_tax >= 0.04 THEN CAST(l_suppkey + 1000 AS VARCHAR) END AS coupon_id
  FROM lineitem
)"""

# Placed orders with their province.
PLACED = """od AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(c_nationkey AS VARCHAR) AS province_id, o_orderdate, o_orderstatus, o_orderpriority
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""

CODES = """dic AS (
  SELECT DISTINCT substring(o_orderpriority, 1, 1) AS rowkey, substring(o_orderpriority, 3) AS dic_name
  FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
  UNION ALL SELECT DISTINCT l_linestatus, 'status ' || l_linestatus FROM lineitem
  UNION ALL SELECT DISTINCT 'r' || l_linenumber, 'reason ' || l_linenumber FROM lineitem WHERE l_linenumber <> 7
)"""

# Versions of order lines (a line is an order and a line number), each with its change since the version before.
VERSIONS = f"""ver AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, l_orderkey, l_shipdate AS et, l_suppkey,
         {PRICE} * CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(6,2)) AS original_raw,
         {ACTIVITY} AS activity_reduce_amount, {COUPON} AS coupon_reduce_amount, {TOTAL} AS order_amount
  FROM lineitem
)"""

SKU_DIMS = """sku AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_brand AS trademark_id, upper(p_brand) AS trademark_name,
         p_type AS category3_id, lower(p_type) AS category3_name, substring(p_type, 1, 2) AS category2_id,
         'c2 ' || substring(p_type, 1, 2) AS category2_name, substring(p_type, 1, 1) AS category1_id,
         CASE WHEN p_type NOT LIKE 'S%' THEN 'c1 ' || substring(p_type, 1, 1) END AS category1_name,
         CAST(p_size AS VARCHAR) AS spu_id, 'spu ' || p_size AS spu_name
  FROM part WHERE p_partkey % 50 <> 0
)"""
