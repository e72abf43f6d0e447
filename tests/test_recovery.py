"""Streams that stop or fail and go on from their checkpoint; order details from state; merge tables."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import cdc, joins, state
from rillmart.plans import dwd
from rillmart.sinks import dims, merge_tables, upserts
from rillmart.streaming import details, queries

T0 = 1_700_000_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small states: each partition of a stateful step starts workers of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def topic(spark):
    def build(*records):
        return cdc.with_row_time(spark.createDataFrame(
            [("shop", table, "insert", T0 + seconds, data, None) for table, seconds, data in records], schemas.ENVELOPE))

    return build


def line(n, order, seconds=0):
    return ("order_detail", seconds, {"id": f"d{n}", "order_id": order, "sku_id": "s"})


def order(name, user="u", seconds=0):
    return ("order_info", seconds, {"id": name, "user_id": user, "province_id": "p"})


def activity(n, value, seconds=0):
    return ("order_detail_activity", seconds, {"order_detail_id": f"d{n}", "activity_id": value, "activity_rule_id": "r"})


def coupon(n, value, seconds=0):
    return ("order_detail_coupon", seconds, {"order_detail_id": f"d{n}", "coupon_id": value})


class Arrivals:
    """A folder in which files arrive one after the other, in order."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, str(folder), 0

    def add(self, *batches):
        for df in batches:
            before = set(os.listdir(self.folder)) if os.path.isdir(self.folder) else set()
            df.coalesce(1).write.mode("append").parquet(self.folder)
            for name in set(os.listdir(self.folder)) - before:
                if name.endswith(".parquet"):
                    os.utime(f"{self.folder}/{name}", (1_700_000_000 + 10 * self.count,) * 2)
            self.count += 1
            self.schema = df.schema
        return self

    def forget(self):
        """What was read is gone from the source."""
        for name in os.listdir(self.folder):
            if name.endswith(".parquet"):
                os.truncate(f"{self.folder}/{name}", 0)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.folder)


BATCHES = [
    (line(1, "o1"), line(2, "o1"), line(3, "o2"), activity(1, "early"), activity(9, "none")),
    (order("o1"), coupon(2, "c"), line(4, "o1")),
    (order("o2"), activity(3, "late"), activity(1, "new", 5)),
]
FINAL = [("d1", "u", "new", None), ("d2", "u", None, "c"), ("d3", "u", "late", None), ("d4", "u", None, None)]


@pytest.mark.parametrize("spread", [1, 3])
def test_details_read_only_their_state(spark, topic, rows, tmp_path, spread):
    """Each micro-batch runs after the files of those before have been emptied, in a query started anew."""
    arrivals, found = Arrivals(spark, tmp_path / "in"), []
    for records in BATCHES:
        arrivals.add(topic(*records))
        versions = details.order_details(arrivals.stream(), "shop", spread=spread)
        queries.each_batch(versions, str(tmp_path / "c"), lambda df, n: found.extend(
            (n, r["id"], r["user_id"], r["activity_id"], r["coupon_id"]) for r in df.collect()), once=True).awaitTermination()
        arrivals.forget()
    assert sorted(found, key=repr) == sorted([
        (1, "d1", "u", "early", None), (1, "d2", "u", None, "c"), (1, "d4", "u", None, None),
        (2, "d1", "u", "new", None), (2, "d3", "u", "late", None)], key=repr)
    lines = spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "known").load(str(tmp_path / "c"))
    assert sorted(r[0] for r in lines.select("key.id").collect()) == ["d1", "d2", "d3", "d4", "d9"]


def test_details_with_repeated_and_broken_records(spark, topic, rows, tmp_path):
    arrivals = Arrivals(spark, tmp_path / "in").add(
        topic(order("o1"), order("o1", "v", 3), line(1, "o1"), line(1, "o1"), activity(1, "b", 2), activity(1, "a", 1)),
        topic(line(1, "o1"), order("o1", "v", 3), ("order_detail", 0, {"order_id": "o1"}), ("order_detail", 0, {"id": "d7"}),
              ("order_info", 0, {"user_id": "x"}), ("order_detail_coupon", 0, {"coupon_id": "x"}), order("none")))
    details.order_detail_versions(arrivals.stream(), str(tmp_path / "c"), str(tmp_path / "out"), once=True).awaitTermination()
    versions = upserts.versions(spark, str(tmp_path / "out"), dwd.order_detail(topic(order("o1"))).schema)
    assert rows(versions, "id", "user_id", "activity_id", upserts.BATCH) == [("d1", "v", "b", 0)]


def test_table_of_details_needs_no_call_per_line(spark, topic, tmp_path):
    """Parts in any order over restarts, a corrected line and order; the state is that of a join, in the JVM."""
    arrivals, table = Arrivals(spark, tmp_path / "in"), details.parts_table(spark, str(tmp_path / "table"), buckets=2)
    for records in BATCHES:
        arrivals.add(topic(*records))
        query = details.order_detail_table(arrivals.stream(), str(tmp_path / "c"), table, once=True, database="shop")
        query.awaitTermination()
        assert {o["operatorName"] for o in query.lastProgress["stateOperators"]} <= {"symmetricHashJoin"}
        arrivals.forget()
        table.compact(tails=2)
    found = details.current(table)
    assert found.schema.names == schemas.ORDER_DETAIL
    assert sorted(tuple(r) for r in found.select("id", "user_id", "activity_id", "coupon_id").collect()) == FINAL
    # A line moved to an order that is not known yet stays as it was; a late version of the old order does not bring it back.
    later = [(line(1, "o3"), activity(2, "x", 9), activity(2, "w", 8)), (order("o3", "w"), order("o2", "z", -5)), (order("o1", "q"),)]
    wanted = ["u", "w", "w"]
    for records, user in zip(later, wanted):
        arrivals.add(topic(*records))
        details.order_detail_table(arrivals.stream(), str(tmp_path / "c"), table, once=True).awaitTermination()
        got = {r["id"]: r for r in details.current(table).collect()}
        assert got["d1"]["user_id"] == user and got["d2"]["activity_id"] == "x" and len(got) == 4
    assert got["d3"]["user_id"] == "z" and got["d4"]["user_id"] == "q" and got["d1"]["order_id"] == "o3"


def test_streamed_details_lie_on_disk_once_and_packed(spark, rows, tmp_path, monkeypatch):
    """What arrives takes about the room of the tables, not that of their records, and the state of the join is packed by zstd."""
    from rillmart.testbed import registry

    jobs = registry.load()
    from rillmart.testbed import stream_queries

    sf, day = str(tmp_path / "sf"), F.timestamp_seconds(F.lit(T0) + F.col("id") % 1000 * 86400)
    n = spark.range(4000)
    n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
             day.alias("o_orderdate")).write.parquet(f"{sf}/orders.parquet")
    spark.range(40).select(F.col("id").alias("c_custkey"), (F.col("id") % 7).alias("c_nationkey")).write.parquet(f"{sf}/customer.parquet")
    hashed = F.pmod(F.xxhash64("id"), F.lit(90_000))
    spark.range(16_000).select(
        F.when(F.col("id") % 100 > 0, F.pmod(hashed, F.lit(4400))).alias("l_orderkey"), F.col("id").alias("l_partkey"),
        (hashed % 100).alias("l_suppkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"), F.lit(3.0).alias("l_quantity"),
        (hashed / 100).alias("l_extendedprice"), (F.col("id") % 11 / 100).alias("l_discount"), (F.col("id") % 9 / 100).alias("l_tax"),
        day.alias("l_shipdate")).write.parquet(f"{sf}/lineitem.parquet")
    folder = str(tmp_path / "scratch")
    monkeypatch.setattr(stream_queries, "scratch", lambda spark: folder)
    before = spark.conf.get("spark.sql.streaming.stateStore.compression.codec")
    found = jobs["stream_order_detail"].run(spark, sf)
    wanted = jobs["order_detail"].run(spark, sf)
    assert rows(found, *schemas.ORDER_DETAIL) == rows(wanted, *schemas.ORDER_DETAIL) and found.count() > 10_000
    assert found.filter("activity_id IS NOT NULL").count() > 1000 and found.filter("coupon_id IS NOT NULL").count() > 1000

    def size(*parts):
        return sum(os.path.getsize(os.path.join(top, f)) for top, _, files in os.walk(os.path.join(*parts)) for f in files)

    assert size(folder, "in") < 2 * size(sf)
    with open(os.path.join(folder, "checkpoint", "offsets", "0")) as first:
        assert json.loads(first.read().split("\n")[1])["conf"]["spark.sql.streaming.stateStore.compression.codec"] == "zstd"
    assert spark.conf.get("spark.sql.streaming.stateStore.compression.codec") == before
    batches = os.listdir(os.path.join(folder, "checkpoint", "offsets"))
    assert len([name for name in batches if name.isdigit()]) >= 2


def test_details_forget_after_their_life_time(spark, topic, tmp_path):
    """Lifetime in processing time: a line whose order comes too late is gone."""
    arrivals, found = Arrivals(spark, tmp_path / "in"), []

    def go(*records):
        # With a life time micro-batches go on without rows, so the query is stopped once these were read.
        arrivals.add(topic(*records))
        seen = []
        query = queries.each_batch(details.order_details(arrivals.stream(), ttl="12 seconds"), str(tmp_path / "c"),
                                   lambda df, n: seen.append(found.extend(r["id"] for r in df.collect())), trigger="1 second")
        until = time.time() + 60
        while not any(p["numInputRows"] for p in query.recentProgress) and time.time() < until:
            time.sleep(0.2)
        query.stop()

    go(line(1, "o1"), line(2, "o2"), order("o2"))
    time.sleep(13)
    go(order("o1"), line(3, "o1"))
    assert sorted(found) == ["d2", "d3"]


class Failing:
    """Writes a micro-batch, and the first time a certain one comes, fails before or after that."""

    def __init__(self, path, batch, after):
        self.path, self.batch, self.after, self.failed = path, batch, after, False

    def __call__(self, df, batch):
        fails = batch == self.batch and not self.failed
        if fails and not self.after:
            # The whole micro-batch runs, and with it its state is stored.
            df.count()
        else:
            upserts.append(df, self.path, batch)
        if fails:
            self.failed = True
            raise RuntimeError("injected")


def day(n, hour=0):
    return dt.datetime(2024, 1, 1 + n, hour)


VISITS = [[("a", day(0), "1"), ("b", day(0), "0")], [("a", day(1), "1"), ("b", day(0, 5), "1")],
          [("a", day(1, 2), "1"), ("c", day(1, 3), "1"), ("b", day(2), "1")]]
AMOUNTS = [[("x", day(0), 100), ("y", day(0), 5)], [("x", day(0, 1), 130)], [("x", day(0, 2), 110), ("y", day(0, 3), 9)]]


def _visits(spark):
    return [spark.createDataFrame(rows, "mid string, et timestamp, is_new string") for rows in VISITS]


def _amounts(spark):
    return [spark.createDataFrame(rows, "id string, et timestamp, amount bigint") for rows in AMOUNTS]


def _pairs(arrivals):
    left = arrivals.stream().withWatermark("et", "5 seconds")
    right = arrivals.stream().select(F.col("mid"), F.col("et").alias("rt")).withWatermark("rt", "5 seconds")
    return joins.interval(left, right, ["mid"], "et", "rt", "2 days", "2 days")


JOBS = {
    "repair": (_visits, lambda a: state.repair_is_new(a.stream().withWatermark("et", "9 days"), "mid", "et", "is_new")),
    "first_of_day": (_visits, lambda a: state.first_of_day(a.stream().withWatermark("et", "9 days"), ["mid"], "et")),
    "delta": (_amounts, lambda a: state.delta(a.stream().withWatermark("et", "9 days"), ["id"], ["et"], ["amount"])),
    "interval": (_visits, _pairs),
}


@pytest.mark.parametrize("name, after", [("repair", False), ("first_of_day", True), ("delta", False), ("interval", True)])
def test_a_failed_batch_leaves_no_trace(spark, rows, tmp_path, name, after):
    """A failure between the state and the sink, or after the sink, and a stop after every micro-batch: rows and state are those
    of a run without."""
    batches, job = JOBS[name]
    found = {}
    for kind in ("whole", "failing"):
        folder = tmp_path / kind
        arrivals = Arrivals(spark, folder / "in")
        sink = Failing(str(folder / "out"), 1 if kind == "failing" else None, after)
        parts = batches(spark)
        if kind == "whole":
            arrivals.add(*parts)
            queries.each_batch(job(arrivals), str(folder / "c"), sink, once=True).awaitTermination()
        else:
            for part in parts:
                arrivals.add(part)
                for _ in range(2):
                    try:
                        queries.each_batch(job(arrivals), str(folder / "c"), sink, once=True).awaitTermination()
                        break
                    except Exception as error:
                        assert "injected" in str(error)
            assert sink.failed
        schema = job(arrivals).schema
        out = rows(spark.read.schema(schema).parquet(str(folder / "out")), *schema.names)
        meta = spark.read.format("state-metadata").load(str(folder / "c"))
        operator = meta.select("operatorId", "operatorName").first()
        reader = spark.read.format("statestore").option("operatorId", operator[0])
        if "transformWithState" in operator[1]:
            reader = reader.option("stateVarName", "last")
        else:
            reader = reader.option("storeName", "left-keyWithIndexToValue")
        kept = reader.load(str(folder / "c"))
        found[kind] = out, sorted(repr((r["key"], r["value"])) for r in kept.collect())
    assert found["whole"] == found["failing"]
    assert found["whole"][0] and found["whole"][1]


# merge tables

SCHEMA = "id string, at int, n int"


def table_of(spark, tmp_path, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    return merge_tables.MergeTable(spark, str(tmp_path / "table"), schema, ("id",), ("at",), **{"buckets": 4, **more})


def frame(spark, *records):
    return spark.createDataFrame(records, SCHEMA)


def test_merge_table_keeps_the_last_row(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    assert rows(table.read()) == [] and table.compact() == [] and table.unused() == []
    table.merge(frame(spark, ("a", 2, 1), ("a", 1, 0), ("b", 1, 1)), 0)
    table.merge(frame(spark, ("a", 0, 5), ("c", 1, 1)), 1)
    table.merge(frame(spark, ("b", 9, 9)), 1)
    table.merge(frame(spark), 2)
    assert rows(table.read()) == [("a", 0, 5), ("b", 1, 1), ("c", 1, 1)]
    assert rows(table.lookup(frame(spark, ("a", 0, 0), ("zz", 0, 0)))) == [("a", 0, 5)]


def test_merge_table_point_reads_touch_few_files(spark, tmp_path):
    table = table_of(spark, tmp_path, buckets=16)
    for batch in range(3):
        table.merge(spark.range(200).selectExpr("string(id) AS id", f"{batch} AS at", "1 AS n"), batch)
    key = frame(spark, ("17", 0, 0))
    (bucket,) = table.touched(key)
    files = table.versions([bucket]).inputFiles()
    assert len(files) == 3 and all(f"_bucket={bucket}/" in name for name in files)
    assert len(table.versions().inputFiles()) == 48
    assert [r["at"] for r in table.lookup(key).collect()] == [2]


def test_merge_table_compaction_of_grown_buckets_only(spark, rows, tmp_path):
    table = table_of(spark, tmp_path)
    table.merge(spark.range(50).selectExpr("string(id) AS id", "0 AS at", "0 AS n"), 0)
    for batch in (1, 2):
        table.merge(frame(spark, ("7", batch, batch)), batch)
    (hot,) = table.touched(frame(spark, ("7", 0, 0)))
    old, wanted = table.manifest(), rows(table.read())
    reader = table.read(manifest=old)
    assert table.compact(tails=3) == [hot]
    assert rows(reader) == rows(table.read()) == wanted
    assert table.manifest().tails()[hot] == 1 and len(table.versions([hot]).inputFiles()) == 1
    assert table.versions([hot]).count() == len([1 for r in wanted if table.touched(frame(spark, r)) == [hot]])
    assert len(table.unused()) == 2 and all("tail-" in name for name in table.unused())
    table.merge(frame(spark, ("7", 0, 30)), 3)
    assert [r["n"] for r in table.lookup(frame(spark, ("7", 0, 0))).collect()] == [30]


def test_a_failed_write_does_not_count(spark, rows, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path)
    table.merge(frame(spark, ("a", 1, 1)), 0)

    def broken(self, manifest):
        raise OSError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(merge_tables.MergeTable, "_commit", broken)
        with pytest.raises(OSError):
            table.merge(frame(spark, ("a", 2, 2)), 1)
    assert rows(table.read()) == [("a", 1, 1)] and len(table.unused()) == 1
    table.merge(frame(spark, ("a", 2, 2)), 1)
    assert rows(table.read()) == [("a", 2, 2)]
    with pytest.raises(RuntimeError):
        table._commit(table.manifest())


def test_merge_table_of_dimensions(spark, rows, tmp_path):
    columns = "sink_table string, row_key string, type string, ts long, data map<string,string>"

    def changes(*records):
        return spark.createDataFrame(records, columns)

    table = dims.merge_table(spark, str(tmp_path / "dims"), buckets=4)
    table.merge(changes(("d", "1", "insert", 5, {"id": "1", "n": "x"}), ("e", "1", "insert", 5, {"id": "1"}),
                        ("d", "3", "insert", 5, {"id": "3", "n": "gone"})), 0)
    table.merge(changes(("d", "1", "update", 6, {"id": None, "n": "y"}), ("d", "2", "insert", 5, {"id": "2", "n": None}),
                        ("d", "3", "delete", 7, {})), 1)
    wanted = [("1", "1", "y"), ("2", "2", None)]
    for _ in range(2):
        assert rows(dims.current(table, "d", ["id", "n"])) == wanted
        keys = spark.createDataFrame([("1",), ("1",), ("3",)], "row_key string")
        assert rows(dims.current(table, "d", ["id", "n"], keys)) == wanted[:1]
        table.compact(tails=1)
    assert rows(table.versions().filter("type = 'delete'")) == []


# snapshot, then changes

HANDOVER = {
    "repair": (VISITS, "mid string, et timestamp, is_new string",
               lambda df, past: state.repair_is_new(df, "mid", "et", "is_new", past=past)),
    "first_of_day": (VISITS, "mid string, et timestamp, is_new string",
                     lambda df, past: state.first_of_day(df, ["mid"], "et", past=past)),
    "first_ever": (VISITS, "mid string, et timestamp, is_new string",
                   lambda df, past: state.first_ever(df, "mid", "et", past=past)),
    "delta": (AMOUNTS, "id string, et timestamp, amount bigint",
              lambda df, past: state.delta(df, ["id"], ["et"], ["amount"], past=past)),
}


@pytest.mark.parametrize("name", sorted(HANDOVER))
def test_a_stream_goes_on_where_the_batch_ended(spark, rows, tmp_path, name):
    parts, schema, job = HANDOVER[name]
    past, *later = [spark.createDataFrame(part, schema) for part in parts]
    arrivals = Arrivals(spark, tmp_path / "in").add(*later)
    out = str(tmp_path / "out")
    streamed = job(arrivals.stream().withWatermark("et", "9 days"), past)
    queries.each_batch(streamed, str(tmp_path / "c"), lambda df, n: upserts.append(df, out, n), once=True).awaitTermination()
    whole = past
    for part in later:
        whole = whole.unionByName(part)
    got = spark.read.parquet(out).select(*schema_names(schema)).unionByName(job(past, None).select(*schema_names(schema)))
    assert rows(got) == rows(job(whole, None), *schema_names(schema))


def schema_names(schema):
    return [field.split()[0] for field in schema.split(", ")]


def test_details_go_on_from_a_snapshot(spark, topic, rows, tmp_path):
    past = topic(*BATCHES[0], *BATCHES[1])
    arrivals = Arrivals(spark, tmp_path / "in").add(topic(*BATCHES[2]))
    versions, found = details.order_details(arrivals.stream(), "shop", spread=2, past=past), []
    queries.each_batch(versions, str(tmp_path / "c"), lambda df, n: found.extend(df.collect()), once=True).awaitTermination()
    assert sorted((r["id"], r["user_id"], r["activity_id"]) for r in found) == [("d1", "u", "new"), ("d3", "u", "late")]
