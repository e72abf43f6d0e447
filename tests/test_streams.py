"""Streams against batch, stream joins, and sinks that are run twice."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import cdc, state
from rillmart.plans import dim, dwd, dws
from rillmart.sinks import dims, tables as table_sinks, topics, upserts
from rillmart.sources import messages, tables
from rillmart.streaming import details as corrections
from rillmart.streaming import queries

T0 = 1_700_000_000


def change(table, seconds, data, kind="insert", old=None):
    return ("shop", table, kind, T0 + seconds, data, old)


@pytest.fixture
def topic(spark):
    return lambda *records: cdc.with_row_time(spark.createDataFrame(records, schemas.ENVELOPE))


def run(df, tmp_path, name="run"):
    table_sinks.append(df, str(tmp_path / name / "out"), str(tmp_path / name / "c"), once=True).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name / "out"))


ORDER = change("order_info", 1, {"id": "o1", "user_id": "u", "province_id": "p"})
LINES = [change("order_detail", s, {"id": f"d{s}", "order_id": "o1", "sku_id": "s"}) for s in (2, 3)]
ACTIVITY = change("order_detail_activity", 4, {"order_detail_id": "d2", "activity_id": "a", "activity_rule_id": "r"})
LATER = change("order_detail", 10_000, {"id": "dx", "order_id": "none"})


def test_order_detail_as_a_bounded_stream(topic, feed, rows, tmp_path):
    """Lines come out once: with the activity when there is one in time, without it after the bound."""
    df = feed("topic", topic(ORDER, *LINES), topic(ACTIVITY), topic(LATER), topic(LATER))
    out = run(dwd.order_detail(df, "shop", bound="30 seconds"), tmp_path)
    assert rows(out, "id", "province_id", "activity_id") == [("d2", "p", "a"), ("d3", "p", None)]


def test_order_detail_with_corrections(spark, topic, feed, rows, tmp_path):
    """A line is there at once; the activity of a later batch gives a new version; a batch run twice changes nothing."""
    df = feed("topic", topic(ORDER, *LINES), topic(ACTIVITY), topic(LATER))
    folder = str(tmp_path)
    corrections.order_detail_versions(df, f"{folder}/c", f"{folder}/out", once=True).awaitTermination()
    schema = dwd.order_detail(topic(ORDER)).schema
    versions = upserts.versions(spark, f"{folder}/out", schema)
    assert rows(versions, "id", "activity_id", upserts.BATCH) == [("d2", "a", 1), ("d2", None, 0), ("d3", None, 0)]
    current = upserts.read(spark, f"{folder}/out", schema, ["id"])
    assert rows(current, "id", "activity_id") == [("d2", "a"), ("d3", None)]


def test_late_order_corrects_its_lines(spark, topic, feed, rows, tmp_path):
    df = feed("topic", topic(*LINES), topic(ORDER))
    folder = str(tmp_path)
    corrections.order_detail_versions(df, f"{folder}/c", f"{folder}/out", once=True).awaitTermination()
    current = upserts.read(spark, f"{folder}/out", dwd.order_detail(topic(ORDER)).schema, ["id"])
    assert rows(current, "id", "user_id") == [("d2", "u"), ("d3", "u")]


def test_payments_as_a_stream(spark, topic, feed, rows, tmp_path):
    def paid(order, seconds, before="1601"):
        return change("payment_info", seconds, {"id": "x", "order_id": order, "user_id": "u", "payment_type": "1",
                                                "payment_status": "1602"}, "update", {"payment_status": before})

    df = feed("topic", topic(paid("o1", -15), paid("o2", 5), paid("o3", 6), paid("o4", 0, None)))
    lines = spark.createDataFrame([(f"d{n}", f"o{n}", T0) for n in (1, 2, 3, 4)], "id string, order_id string, ts long")
    for name in schemas.ORDER_DETAIL:
        if name not in lines.columns:
            lines = lines.withColumn(name, F.lit("v"))
    details = feed("details", lines.withColumn("row_time", F.timestamp_seconds("ts")))
    dic = tables.code_table(spark.createDataFrame([("1", "card")], "dic_code string, dic_name string"))
    out = run(dwd.payments(df, details, dic, "shop"), tmp_path)
    assert out.columns == schemas.PAYMENT
    assert rows(out, "id", "payment_type_name") == [("d1", "card"), ("d2", "card")]


def test_a_left_join_of_streams_needs_a_bound(topic, feed):
    with pytest.raises(ValueError):
        dwd.order_detail(feed("topic", topic(ORDER)), "shop")


def test_an_inner_join_of_streams_without_bound_finds_far_pairs(topic, feed, rows, tmp_path):
    """The cancel comes days after the line."""
    days = 30 * 86_400
    cancel = change("order_info", days, {"id": "o1", "order_status": "1003", "operate_time": "t"}, "update",
                    {"order_status": "1001"})
    details = dwd.order_detail(topic(ORDER, *LINES), "shop").withColumn("row_time", F.timestamp_seconds("ts"))
    cancels = dwd.order_cancels(feed("topic", topic(LATER), topic(cancel)), feed("details", details), "shop")
    assert rows(run(cancels, tmp_path), "id", "operate_time") == [("d2", "t"), ("d3", "t")]


def test_corrections_of_any_age(spark, topic, feed, rows, tmp_path):
    """An activity that comes a month after its line still gives a version."""
    activity = ("shop", "order_detail_activity", "insert", T0 + 30 * 86_400, ACTIVITY[4], None)
    df = feed("topic", topic(ORDER, *LINES), topic(activity))
    folder = str(tmp_path)
    corrections.order_detail_versions(df, f"{folder}/c", f"{folder}/out", once=True).awaitTermination()
    current = upserts.read(spark, f"{folder}/out", dwd.order_detail(topic(ORDER)).schema, ["id"])
    assert rows(current, "id", "activity_id") == [("d2", "a"), ("d3", None)]


@pytest.mark.parametrize("forget", [False, True])
def test_first_ever_in_a_stream_is_the_earliest_row(spark, feed, rows, tmp_path, forget):
    """Within a micro-batch time and tie-break decide, null ties first; later micro-batches find the key known."""
    def batch(*records):
        return spark.createDataFrame([(k, dt.datetime(2024, 1, 1, 0, s), n) for k, s, n in records],
                                     "k string, ts timestamp, n int")

    df = feed("rows", batch(("a", 9, 1), ("a", 5, 3), ("a", 5, 2), ("b", 7, None), ("b", 7, 1), ("b", 8, 0)),
              batch(("a", 10, 9), ("c", 10, 8))).withWatermark("ts", "30 minutes")
    out = run(state.first_ever(df, "k", "ts", ("n",), forget), tmp_path)
    assert rows(out, "k", "n") == [("a", 2), ("b", None), ("c", 8)]


def test_messages_keep_their_place(spark, rows, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([('{"id":"1","ts":5}',)], "value string").write.text(folder)
    read = messages.files(spark, folder, stream=False, place=True)
    table = tables.order_details(read, None, messages.FILE_PLACE)
    assert [(r.id, r.file_time is not None, r.file_name.endswith(".txt")) for r in table.collect()] == [("1", True, True)]
    assert messages.files(spark, folder, stream=False).columns == ["value"]


def page(mid, seconds, page_id="home", **more):
    return {"common": {"mid": mid, "uid": mid, "sid": f"{mid}-{seconds // 60}", "vc": "v", "ch": "c", "ar": "a",
                       "is_new": "0"}, "page": {"page_id": page_id, "during_time": 7, **more}, "ts": (T0 + seconds) * 1000}


def test_summaries_of_a_stream_equal_those_of_closed_batch_windows(spark, feed, rows, tmp_path):
    records = [page(f"m{n % 5}", n * 7, ("home", "good_detail")[n % 2], last_page_id=None, item="a b",
                    item_type="keyword") for n in range(60)]
    lines = [spark.createDataFrame([(json.dumps(r),) for r in records[i:i + 20]], "value string") for i in (0, 20, 40)]
    batch = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    last = max(r["ts"] for r in records) // 1000 - 5
    for name, job in (("traffic", dws.traffic), ("home", dws.home_detail), ("logins", dws.logins)):
        from rillmart.operators import logs
        streamed = run(job(logs.pages(feed(name, *lines)), as_of="2024-01-01"), tmp_path, f"run-{name}")
        whole = job(logs.pages(batch), as_of="2024-01-01")
        closed = whole.filter(F.unix_timestamp("edt") <= last)
        assert rows(streamed) == rows(closed) and streamed.count() > 0


def test_late_rows_are_left_out(spark, feed, rows, tmp_path):
    def users(*seconds):
        return spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s).strftime("%Y-%m-%d %H:%M:%S"),) for s in seconds],
                                     "create_time string")

    df = feed("users", users(1, 2), users(30), users(31), users(3), users(59))
    out = run(dws.registrations(df, as_of="2024-01-01"), tmp_path)
    assert rows(out, "stt", "register_ct") == [("2024-01-01 00:00:00", 2), ("2024-01-01 00:00:30", 2)]


def test_json_messages(spark, rows, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([('{"id":"1","ts":5}',), ("broken",)], "value string").write.text(folder)
    df = tables.order_details(messages.files(spark, folder))
    out = run(df.select("id", "order_id", "ts", "row_time"), tmp_path)
    assert rows(out.filter("id is not null"), "id", "order_id", "ts") == [("1", None, 5)]
    batch = tables.page_log(messages.files(spark, folder, stream=False))
    assert batch.columns == ["page", "ts", "et"]


def test_config_feed(spark, rows):
    text = '{"op":"d","before":{"source_table":"a","sink_table":"s"},"after":null,"ts_ms":3}'
    df = tables.config_feed(spark.createDataFrame([(text,)], "value string"), schemas.DIM_CONFIG)
    assert rows(df, "op", "before.source_table", "ts_ms") == [("d", "a", 3)]


def test_routed_messages_carry_the_payload_alone(spark, rows):
    df = spark.createDataFrame([("t1", {"a": "1"}), ("t2", {"b": "2"})], "sink_table string, data map<string,string>")
    assert rows(topics.routed(df)) == [("t1", '{"a":"1"}'), ("t2", '{"b":"2"}')]


def test_messages_with_a_key(spark):
    df = spark.createDataFrame([("7", "x", 1)], "id string, skuName string, hidden int")
    assert topics.as_json(df, drop=("hidden",), key="id").first() == ("7", '{"id":"7","sku_name":"x"}')


def test_upserts_survive_a_repeated_batch_and_compaction(spark, rows, tmp_path):
    path, schema = str(tmp_path / "log"), "id string, n int"
    first = spark.createDataFrame([("a", 1), ("b", 1)], schema)
    second = spark.createDataFrame([("a", 2)], schema)
    for batch, df in ((0, first), (1, second), (1, second)):
        upserts.append(df, path, batch)
    assert upserts.versions(spark, path, first.schema).count() == 3
    assert rows(upserts.read(spark, path, first.schema, ["id"])) == [("a", 2), ("b", 1)]
    upserts.compact(spark, path, str(tmp_path / "compact"), first.schema, ["id"])
    assert upserts.versions(spark, str(tmp_path / "compact"), first.schema).count() == 2
    assert rows(upserts.read(spark, str(tmp_path / "compact"), first.schema, ["id"])) == [("a", 2), ("b", 1)]


def test_dimension_sink(spark, rows, tmp_path):
    path, columns = str(tmp_path / "dims"), "sink_table string, row_key string, type string, ts long, data map<string,string>"
    dims.append(spark.createDataFrame([("d", "1", "insert", 5, {"id": "1", "n": "x"}), ("e", "1", "insert", 5, {"id": "1"})],
                                      columns), path, 0)
    dims.append(spark.createDataFrame([("d", "1", "update", 5, {"id": "1", "n": None}), ("d", "2", "insert", 5, {"id": "2"})],
                                      columns), path, 1)
    assert rows(dims.read(spark, path, "d", ["id", "n"])) == [("1", "1", "x"), ("2", "2", None)]


def test_live_configuration_is_read_per_micro_batch(spark, topic, feed, rows, tmp_path):
    current = {"columns": "id"}

    def config():
        found = spark.createDataFrame([("u", "dim_u", current["columns"], "info", "id")], schemas.DIM_CONFIG)
        current["columns"] = "id,name"
        return found

    df = feed("topic", topic(change("u", 0, {"id": "1", "name": "a"})), topic(change("u", 1, {"id": "2", "name": "b"})))
    queries.with_live_config(
        df, str(tmp_path / "c"), config, lambda r, c, n: dims.append(dim.changes(r, c, "shop"), str(tmp_path / "d"), n),
        once=True).awaitTermination()
    assert rows(dims.read(spark, str(tmp_path / "d"), "dim_u", ["id", "name"])) == [("1", "1", None), ("2", "2", "b")]
