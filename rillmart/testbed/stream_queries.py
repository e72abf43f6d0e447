"""Jobs and sinks run as streams over the test tables, to completion, with their output read back.

Windows that the watermark has not closed stay in the state; the checking SQL leaves them out as well.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..operators import bitmaps, enrich, joins, routing, state, windows
from ..plans import dim, dwd, dws
from ..sinks import dims as dim_sink
from ..sinks import merge_tables, tables, topics, upserts
from ..streaming import details, queries
from . import shapes, sql
from .detail_queries import (
    CONFIG_AS_OF, REPAIRED, config_history, dim_config, fact_config, routed_topic, split_fields,
)
from .registry import AS_OF, QUERIES, query
from .summary_queries import PROVINCE_SQL

_DAY = "1 day"
# Files of one part of a table and of one micro-batch, where parts arrive one after the other.
_FILES = 4
# Rows of a file of a streamed table, about.
_ROWS = 1_000_000


def scratch(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder."""
    return session.shared_dir(spark, f"rillmart-{uuid.uuid4().hex}")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream, be it one file or a folder of files."""
    table, path = shapes.table(spark, sf_dir, name), f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table.schema)
    if table.inputFiles()[0].endswith(f"/{name}.parquet"):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def _arriving(spark: SparkSession, rows: DataFrame, folder: str, batches: int, files: int) -> DataFrame:
    """Rows written to at least so many files, more for a large table, and streamed in so many micro-batches, in any order."""
    parts = max(files, math.ceil(rows.count() / _ROWS))
    rows.repartition(parts).write.parquet(folder)
    written = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", math.ceil(written / batches)).parquet(folder)


def _appended(spark: SparkSession, df: DataFrame) -> DataFrame:
    """What a finished stream has appended to a table."""
    folder = scratch(spark)
    tables.append(df, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _closed(of: str, latest: str) -> str:
    """The rows of a summary whose window the watermark has closed."""
    return f"SELECT * FROM ({of}) WHERE strptime(edt, '{sql.STAMP}') <= (SELECT {latest}) - INTERVAL '5 seconds'"


_LAST_EVENT = "max(make_timestamp(epoch_us(ts) // 1000 * 1000)) FROM events"


def _pages(spark, sf_dir) -> DataFrame:
    return shapes.pages(shapes.with_k(stream(spark, sf_dir, "events")))


_TRAFFIC = _closed(QUERIES["traffic_window"].sql, _LAST_EVENT)


@query("stream_traffic", _TRAFFIC)
def stream_traffic(spark, sf_dir):
    return _appended(spark, dws.traffic(_pages(spark, sf_dir), "1 hour", as_of=AS_OF))


@query("stream_traffic_files", _TRAFFIC)
def stream_traffic_files(spark, sf_dir):
    """The same events in many files, in no order of time."""
    folder = scratch(spark)
    events = shapes.with_k(shapes.table(spark, sf_dir, "events"))
    events.repartition(7, "event_id").sortWithinPartitions(F.xxhash64("event_id")).write.parquet(f"{folder}/in")
    pages = shapes.pages(spark.readStream.schema(events.schema).parquet(f"{folder}/in"))
    return _appended(spark, dws.traffic(pages, "1 hour", as_of=AS_OF))


@query("stream_cart_users", _closed(QUERIES["cart_users"].sql, "max(ts) FROM events WHERE event_type = 'click'"))
def stream_cart_users(spark, sf_dir):
    clicks = stream(spark, sf_dir, "events").filter("event_type = 'click'")
    carts = clicks.select(shapes.text("user_id").alias("user_id"), shapes.seconds(F.col("ts")).alias("ts"))
    return _appended(spark, dws.cart_users(carts, "1 hour", as_of=AS_OF))


@query("stream_order_users", _closed(QUERIES["order_users"].sql, "max(o_orderdate) FROM orders"))
def stream_order_users(spark, sf_dir):
    orders = stream(spark, sf_dir, "orders")
    placed = orders.select(shapes.text("o_custkey").alias("user_id"), shapes.seconds(F.col("o_orderdate")).alias("ts"))
    return _appended(spark, dws.order_users(placed, _DAY, as_of=AS_OF))


@query("stream_logins", _closed(
    QUERIES["logins_back_after_2_days"].sql,
    "max(et) FROM (WITH " + sql.PAGES + " SELECT et FROM pg WHERE uid IS NOT NULL AND "
    "(last_page_id IS NULL OR last_page_id = 'login'))"))
def stream_logins(spark, sf_dir):
    return _appended(spark, dws.logins(_pages(spark, sf_dir), _DAY, as_of=AS_OF, days=2))


_KEYWORDS = QUERIES["keyword_count"].sql.replace("window_start", "stt").replace("window_end", "edt")
_SEARCHED = ("max(et) FROM (WITH " + sql.PAGES +
             " SELECT et FROM pg WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword')")


@query("stream_keyword_count", _closed(_KEYWORDS, _SEARCHED).replace(
    "SELECT * FROM", "SELECT * RENAME (stt AS window_start, edt AS window_end) FROM", 1))
def stream_keyword_count(spark, sf_dir):
    return _appended(spark, dws.keyword_count(_pages(spark, sf_dir), "1 hour", as_of=AS_OF))


@query("stream_province_orders", _closed(PROVINCE_SQL, "max(l_shipdate) FROM lineitem"))
def stream_province_orders(spark, sf_dir):
    lines = shapes.line_versions(stream(spark, sf_dir, "lineitem"))
    details = shapes.with_province(lines, shapes.table(spark, sf_dir, "orders"), shapes.table(spark, sf_dir, "customer"))
    folder = scratch(spark)
    # The table comes in one micro-batch, so that each group has many rows.
    with queries.key_groups(spark, 1 << 14):
        sums = dws.province_sums(details, ("et",), _DAY, as_of=AS_OF)

    def provinces() -> DataFrame:
        return shapes.provinces(shapes.table(spark, sf_dir, "nation"))

    with queries.uncounted_state(spark):
        query = queries.with_live_tables(sums, f"{folder}/checkpoint", provinces, dws.with_provinces, f"{folder}/out", once=True)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop(upserts.BATCH)


_TURN = "1995-06-01"


@query("stream_live_provinces", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id,
       CASE WHEN c_nationkey < 12 OR o_orderdate >= TIMESTAMP '{_TURN}' THEN n_name END AS province_name
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def stream_live_provinces(spark, sf_dir):
    """The later half of the provinces is added after the first of two micro-batches and is found by the second."""
    folder = scratch(spark)
    nation, customer = shapes.table(spark, sf_dir, "nation"), shapes.table(spark, sf_dir, "customer")
    provinces = shapes.provinces(nation)
    orders = shapes.table(spark, sf_dir, "orders").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    rows = orders.select(shapes.text("o_orderkey").alias("id"), shapes.text("c_nationkey").alias("province_id"),
                         (F.col("o_orderdate") >= _TURN).alias("later"))
    for later in (False, True):
        part = rows.filter(F.col("later") == later).repartition(_FILES)
        part.write.mode("append").parquet(f"{folder}/in")
    early = F.col("id").cast("int") < 12
    provinces.filter(early).write.parquet(f"{folder}/provinces")

    def write(batch_rows: DataFrame, known: DataFrame, batch: int) -> None:
        named = enrich.dim(batch_rows, known, "province_id", {"province_name": "name"}).drop("later")
        upserts.append(named, f"{folder}/out", batch)
        if batch == 0:
            provinces.filter(~early).write.mode("append").parquet(f"{folder}/provinces")

    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _FILES).parquet(f"{folder}/in")
    queries.with_live_config(arriving, f"{folder}/checkpoint", lambda: spark.read.parquet(f"{folder}/provinces"), write,
                             once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop(upserts.BATCH)


@query("stream_late_rows", _closed(f"""
SELECT {sql.window(_DAY, 'ts')}, '{AS_OF}' AS cur_date, count(*) AS event_ct FROM events
WHERE event_id % 2 = 0 OR time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day'
      > (SELECT max(ts) - INTERVAL '5 seconds' FROM events WHERE event_id % 4 = 0)
GROUP BY ALL""", _LAST_EVENT))
def stream_late_rows(spark, sf_dir):
    """Odd events come in a third micro-batch, and those of windows closed before it are left out.

    Spark judges the rows of a micro-batch by the watermark that held in the micro-batch before.
    """
    folder = scratch(spark)
    events = shapes.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("et"))
    for part in ("event_id % 4 = 0", "event_id % 4 = 2", "event_id % 2 = 1"):
        events.filter(part).select("et").repartition(_FILES).write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema("et timestamp").option("maxFilesPerTrigger", _FILES).parquet(f"{folder}/in")
    return _appended(spark, windows.tumble(arriving, "et", _DAY, [], [F.count(F.lit(1)).alias("event_ct")], dwd.DELAY,
                                           AS_OF))


@query("stream_refunds", _closed(QUERIES["refund_by_brand_type_user"].sql,
                                "max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R'"))
def stream_refunds(spark, sf_dir):
    """Orders are told apart in the state of the stream; a window is counted and named in the micro-batch that closes it."""
    returned = shapes.returned_lines(stream(spark, sf_dir, "lineitem"))

    def dims() -> dict[str, DataFrame]:
        return shapes.dims(shapes.table(spark, sf_dir, "part"))

    folder, items = scratch(spark), dws.refund_items(returned, dims(), _DAY)
    queries.with_live_tables(items, f"{folder}/checkpoint", dims, lambda rows, known: dws.refund_counts(rows, known, AS_OF),
                             f"{folder}/out", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop(upserts.BATCH)


@query("stream_home_detail", _closed(
    QUERIES["home_detail_uv"].sql,
    "max(et) FROM (WITH " + sql.PAGES + " SELECT et FROM pg WHERE page_id IN ('home', 'good_detail'))"))
def stream_home_detail(spark, sf_dir):
    return _appended(spark, dws.home_detail(_pages(spark, sf_dir), "1 hour", as_of=AS_OF))


@query("stream_is_new_repair", f"WITH {REPAIRED} SELECT mid, ts, is_new FROM fixed")
def stream_is_new_repair(spark, sf_dir):
    rows = _pages(spark, sf_dir).select("mid", "ts", "is_new").withColumn("et", F.timestamp_millis("ts"))
    rows = rows.withWatermark("et", dwd.LOG_DELAY)
    return _appended(spark, state.repair_is_new(rows, "mid", "et", "is_new", ("ts",)).drop("et"))


_HANDOVER = "2024-01-16"


@query("stream_handover", f"WITH {REPAIRED} SELECT mid, ts, is_new FROM fixed")
def stream_handover(spark, sf_dir):
    """Flags of the first half of the time repaired in batch, those of the rest by a stream that starts from its state."""
    rows = shapes.pages(shapes.events(spark, sf_dir)).select("mid", "ts", "is_new").withColumn("et", F.timestamp_millis("ts"))
    before = F.col("et") < _HANDOVER
    past, folder = rows.filter(before), scratch(spark)
    rows.filter(~before).write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{folder}/in").withWatermark("et", dwd.LOG_DELAY)
    later = _appended(spark, state.repair_is_new(arriving, "mid", "et", "is_new", ("ts",), past=past))
    return state.repair_is_new(past, "mid", "et", "is_new", ("ts",)).unionByName(later).drop("et")


@query("stream_payments", QUERIES["payments_interval"].sql)
def stream_payments(spark, sf_dir):
    def of(kind: str, id_: str, ts: str) -> DataFrame:
        rows = stream(spark, sf_dir, "events").filter(F.col("event_type") == kind)
        timed = rows.select(F.col("event_id").alias(id_), "user_id", F.col("ts").cast("timestamp").alias(ts))
        return timed.withWatermark(ts, dwd.DELAY)

    pairs = joins.interval(of("signup", "signup_id", "st"), of("purchase", "purchase_id", "pt"), ["user_id"], "st",
                           "pt", "15 seconds", "1 hour")
    return _appended(spark, pairs.select("signup_id", "purchase_id", "user_id"))


def _as_they_lie(spark: SparkSession, rows: DataFrame, folder: str, batches: int, files: int) -> list[DataFrame]:
    """Rows written to about so many files, more for a large table, without a shuffle, and a stream of them in so many micro-batches
    from the oldest file on, and one from the newest on."""
    most = max(1, min(_ROWS, math.ceil(rows.count() / files)))
    rows.write.options(maxRecordsPerFile=most, compression="zstd").parquet(folder)
    written = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", math.ceil(written / batches))
    return [reader.option("latestFirst", newest).parquet(folder) for newest in (False, True)]


def _arriving_details(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The change records of `detail_topic`, which arrive over several micro-batches in any order.

    Rows of the tables are put into files, and the records of a micro-batch are made from them: a record is many times as large as
    its row. Orders, activities and coupons come from the newest files on, lines from the oldest on.
    """
    _, orders = _as_they_lie(spark, shapes.table(spark, sf_dir, "orders"), f"{folder}/orders", batches=2, files=4)
    early, late = _as_they_lie(spark, shapes.table(spark, sf_dir, "lineitem"), f"{folder}/lines", batches=2, files=4)
    line = F.col("table") == "order_detail"
    records = shapes.order_lines(early).filter(line).unionByName(shapes.order_lines(late).filter(~line))
    return shapes.order_info(orders, shapes.table(spark, sf_dir, "customer")).unionByName(records)


@query("stream_order_detail", QUERIES["order_detail"].sql)
def stream_order_detail(spark, sf_dir):
    """Orders and lines in any order over several micro-batches; a line meets its order in the state of a join, and a table
    takes in the pair, activities and coupons as parts of the line, whenever they come."""
    folder = scratch(spark)
    records = _arriving_details(spark, sf_dir, f"{folder}/in")
    table = details.parts_table(spark, f"{folder}/table", buckets=8)
    details.order_detail_table(records, f"{folder}/checkpoint", table, once=True,
                               database=shapes.DATABASE).awaitTermination()
    return details.current(table)


@query("stream_log_split", QUERIES["log_split"].sql)
def stream_log_split(spark, sf_dir):
    """Flags repaired by keyed state, then the five-way split into one folder of JSON messages per stream."""
    folder = scratch(spark)
    messages = shapes.log_messages(shapes.with_k(stream(spark, sf_dir, "events")))
    out = dwd.base_log(messages).select("stream", "value")
    topics.files(out, f"{folder}/out", f"{folder}/checkpoint", once=True, partition=["stream"],
                 format="parquet").awaitTermination()
    return split_fields(spark.read.schema("value string, stream string").parquet(f"{folder}/out"))


def _topic(spark, sf_dir) -> DataFrame:
    """Customers and orders as one stream of change records."""
    customer, orders = stream(spark, sf_dir, "customer"), stream(spark, sf_dir, "orders")
    moves = shapes.order_info(orders, shapes.table(spark, sf_dir, "customer"))
    return shapes.user_info(customer).unionByName(shapes.comment_info(orders)).unionByName(moves)


@query("stream_fact_routes", QUERIES["fact_routes"].sql)
def stream_fact_routes(spark, sf_dir):
    """Routing with the configuration read anew for every micro-batch."""
    folder = scratch(spark)

    def write(rows: DataFrame, config: DataFrame, batch: int) -> None:
        routed = dwd.base_db(rows, routing.latest_config(config))
        upserts.append(routed.select("sink_table", "ts", F.to_json("data").alias("value")), f"{folder}/out", batch,
                       partition=["sink_table"])

    queries.with_live_config(_topic(spark, sf_dir), f"{folder}/checkpoint", lambda: fact_config(spark), write,
                             once=True).awaitTermination()
    return spark.read.schema("ts long, value string, sink_table string").option("basePath", f"{folder}/out").parquet(
        f"{folder}/out").select("sink_table", "ts", "value")


@query("stream_dim_table", QUERIES["dim_snapshot"].sql)
def stream_dim_table(spark, sf_dir):
    """Dimension changes appended per micro-batch, and one dimension read back in its current state."""
    folder = scratch(spark)

    def write(rows: DataFrame, config: DataFrame, batch: int) -> None:
        dim_sink.append(dim.changes(rows, config, shapes.DATABASE), f"{folder}/dims", batch)

    queries.with_live_config(_topic(spark, sf_dir), f"{folder}/checkpoint", lambda: dim_config(spark), write,
                             once=True).awaitTermination()
    return dim_sink.read(spark, f"{folder}/dims", "dim_user_info", ["id", "name", "segment"])


@query("stream_dim_compacted", QUERIES["dim_snapshot"].sql)
def stream_dim_compacted(spark, sf_dir):
    """Dimension changes of several batches, compacted, and one dimension read from what is left."""
    folder, topic = scratch(spark), session.settled(dim.changes(
        routed_topic(spark, sf_dir), dim_config(spark), shapes.DATABASE))
    for batch, part in enumerate(("ts < 1715000000", "ts >= 1715000000")):
        dim_sink.append(topic.filter(part), f"{folder}/dims", batch)
    dim_sink.compact(spark, f"{folder}/dims", f"{folder}/compact")
    return dim_sink.read(spark, f"{folder}/compact", "dim_user_info", ["id", "name", "segment"])


@query("stream_upsert_table", QUERIES["latest"].sql)
def stream_upsert_table(spark, sf_dir):
    """A version log written by a stream, compacted, and read as a table."""
    folder = scratch(spark)
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = stream(spark, sf_dir, "lineitem").select(columns)
    queries.each_batch(lines, f"{folder}/checkpoint", lambda rows, batch: upserts.append(rows, f"{folder}/log", batch),
                       once=True).awaitTermination()
    keys, order = columns[:2], ("l_shipdate", "l_partkey", "l_suppkey")
    upserts.compact(spark, f"{folder}/log", f"{folder}/compact", lines.schema, keys, order)
    return upserts.read(spark, f"{folder}/compact", lines.schema, keys, order)


@query("stream_merge_table", QUERIES["latest"].sql)
def stream_merge_table(spark, sf_dir):
    """Versions merged into a bucketed table by several micro-batches, compacted between reads."""
    folder = scratch(spark)
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = shapes.table(spark, sf_dir, "lineitem").select(columns)
    arriving = _arriving(spark, lines, f"{folder}/in", batches=2, files=4)
    table = merge_tables.MergeTable(spark, f"{folder}/table", lines.schema, tuple(columns[:2]),
                                    ("l_shipdate", "l_partkey", "l_suppkey"), buckets=8,
                                    combine=lambda rows: rows, reduce=_last_line)
    queries.each_batch(arriving, f"{folder}/checkpoint", table.merge, once=True).awaitTermination()
    table.compact(tails=2)
    return table.read()


def _last_line(rows: DataFrame) -> DataFrame:
    return state.latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("stream_merge_dims", QUERIES["dim_snapshot"].sql)
def stream_merge_dims(spark, sf_dir):
    """Dimension changes merged per micro-batch, compacted, and one dimension read from the table."""
    folder = scratch(spark)
    table = dim_sink.merge_table(spark, f"{folder}/dims", buckets=8)

    def write(rows: DataFrame, config: DataFrame, batch: int) -> None:
        table.merge(dim.changes(rows, config, shapes.DATABASE), batch)

    queries.with_live_config(_topic(spark, sf_dir), f"{folder}/checkpoint", lambda: dim_config(spark), write,
                             once=True).awaitTermination()
    table.compact(tails=1)
    return dim_sink.current(table, "dim_user_info", ["id", "name", "segment"])


@query("stream_lookups", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS user_id,
       CASE WHEN c_custkey % 14 = 0 THEN 'back' WHEN c_custkey % 7 <> 0 THEN c_name END AS name
FROM orders JOIN customer ON c_custkey = o_custkey""")
def stream_lookups(spark, sf_dir):
    """Orders of several micro-batches meet their customers, looked up in the buckets that a micro-batch touches."""
    folder = scratch(spark)
    table = dim_sink.merge_table(spark, f"{folder}/dims", buckets=8)
    users = shapes.user_info(shapes.table(spark, sf_dir, "customer"))
    table.merge(dim.changes(users, dim_config(spark), shapes.DATABASE), 0)
    orders = shapes.table(spark, sf_dir, "orders").select(
        shapes.text("o_orderkey").alias("id"), shapes.text("o_custkey").alias("user_id"))
    arriving = _arriving(spark, orders, f"{folder}/in", batches=3, files=3)

    def find(rows: DataFrame) -> DataFrame:
        return dim_sink.current(table, "dim_user_info", ["id", "name"], rows.select(F.col("user_id").alias("row_key")))

    queries.with_lookups(
        arriving, f"{folder}/checkpoint", find, lambda rows, known: enrich.dim(rows, known, "user_id", {"name": "name"}),
        f"{folder}/out", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop(upserts.BATCH)


@query("stream_config_as_of", CONFIG_AS_OF)
def stream_config_as_of(spark, sf_dir):
    """The rows of the replay in several micro-batches and no order of time, each routed by the version of its own time."""
    folder, topic = scratch(spark), routed_topic(spark, sf_dir)
    arriving = _arriving(spark, topic, f"{folder}/in", batches=2, files=4)

    def write(rows: DataFrame, config: DataFrame, batch: int) -> None:
        upserts.append(dwd.base_db(rows, config).select("sink_table", "ts", F.to_json("data").alias("value")),
                       f"{folder}/out", batch)

    queries.with_live_config(arriving, f"{folder}/checkpoint", lambda: config_history(spark), write,
                             once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop(upserts.BATCH)


@query("stream_uv_rolled_up", f"""
SELECT {sql.window(_DAY, 'ts')}, event_type, count(DISTINCT user_id) AS uv FROM events
WHERE time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' <= (SELECT max(ts) - INTERVAL '5 seconds' FROM events)
GROUP BY ALL""")
def stream_uv_rolled_up(spark, sf_dir):
    """Bitmaps of 5 seconds appended by a stream, visitors per day from them."""
    events = stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("et"), "user_id", "event_type")
    short = _appended(spark, bitmaps.construct(events, "et", "5 seconds", ["event_type"], "user_id", dwd.DELAY))
    return bitmaps.counts(bitmaps.roll_up(short, _DAY, ["event_type"]), ["event_type"], "uv")


@query("stream_idle_input", _closed(f"""
SELECT {sql.window('1 hour', 'ts')}, '{AS_OF}' AS cur_date, count(*) AS event_ct FROM events
WHERE event_type <> 'click' OR ts < TIMESTAMP '2024-01-02' GROUP BY ALL""", "max(ts) FROM events WHERE event_type <> 'click'"))
def stream_idle_input(spark, sf_dir):
    """Two inputs, one of which has no rows after the first day: windows close by the other."""
    folder = scratch(spark)
    events = shapes.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("et"), "event_type")
    clicks = F.col("event_type") == "click"
    events.filter(~clicks).write.parquet(f"{folder}/busy")
    events.filter(clicks & (F.col("et") < "2024-01-02")).write.parquet(f"{folder}/idle")

    def of(name: str) -> DataFrame:
        return spark.readStream.schema(events.schema).parquet(f"{folder}/{name}").withWatermark("et", dwd.DELAY)

    counted = windows.tumble(of("busy").unionByName(of("idle")), "et", "1 hour", [], [F.count(F.lit(1)).alias("event_ct")],
                             None, AS_OF)
    with queries.idle_inputs(spark):
        return _appended(spark, counted)
