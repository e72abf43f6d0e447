"""Per-key history: the hand cases, and the split forms against a plain walk over skewed rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rillmart.operators import skew, state
from rillmart.streaming import history, queries


def at(day, hour=12, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def test_repair_is_new_hand_case(spark, rows):
    df = spark.createDataFrame(
        [("a", at(1, 1), "1", 1), ("a", at(1, 2), "1", 2), ("a", at(2), "1", 3), ("a", at(3, 1), "0", 4),
         ("a", at(3, 2), "1", 5)],
        "mid string, ts timestamp, is_new string, id int",
    )
    fixed = state.repair_is_new(df, "mid", "ts", "is_new", ("id",))
    assert rows(fixed, "id", "is_new") == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0")]


def walk_is_new(records):
    known, out = {}, []
    for mid, ts, flag, number in sorted(records, key=lambda r: (r[1], r[3])):
        day = ts.date()
        if flag == "1":
            if mid not in known:
                known[mid] = day
            elif known[mid] != day:
                flag = "0"
        elif flag == "0":
            known[mid] = day - dt.timedelta(days=1)
        out.append((number, flag))
    return sorted(out, key=str)


def skewed(seed, count=600):
    """A third of all rows belongs to key k0; many equal times."""
    rng = random.Random(seed)
    return [
        ("k0" if rng.random() < 0.34 else f"k{rng.randint(1, 40)}",
         at(rng.randint(1, 9), rng.randint(0, 23)), rng.choice("110"), number)
        for number in range(count)
    ]


@pytest.mark.parametrize("limit", [None, 20])
def test_repair_is_new_against_a_walk(spark, rows, limit):
    records = skewed(1)
    df = spark.createDataFrame(records, "mid string, ts timestamp, is_new string, id int")
    heavy = skew.heavy_keys(df, ["mid"], limit) if limit else None
    fixed = state.repair_is_new(df, "mid", "ts", "is_new", ("id",), heavy=heavy, copies=True)
    assert rows(fixed, "id", "is_new") == walk_is_new(records)


def test_day_changes_hand_case(spark, rows):
    """Days d1, d1, d2, d1 in arrival order give 1, 0, 1, 1."""
    df = spark.createDataFrame([("u", at(1), 1), ("u", at(1, 13), 2), ("u", at(2), 3), ("u", at(1, 14), 4)],
                               "k string, ts timestamp, n int")
    assert rows(state.day_changes(df, "k", "ts", ["n"]), "n") == [(1,), (3,), (4,)]


@pytest.mark.parametrize("limit", [None, 20])
def test_day_changes_against_a_walk(spark, rows, limit):
    records = skewed(2)
    df = spark.createDataFrame(records, "k string, ts timestamp, f string, n int")
    heavy = skew.heavy_keys(df, ["k"], limit) if limit else None
    last, expected = {}, []
    for key, ts, _, number in records:
        if last.get(key) != ts.date():
            expected.append((number,))
        last[key] = ts.date()
    assert rows(state.day_changes(df, "k", "ts", ["n"], heavy=heavy), "n") == sorted(expected, key=str)


def test_first_of_day_and_first_ever(spark, rows):
    df = spark.createDataFrame([("u", at(1, 9), 1), ("u", at(1, 8), 2), ("u", at(2), 3), ("v", at(2), 4)],
                               "k string, ts timestamp, n int")
    assert rows(state.first_of_day(df, ["k"], "ts", ("n",)), "n") == [(2,), (3,), (4,)]
    assert rows(state.first_ever(df, "k", "ts", ("n",)), "n") == [(2,), (4,)]


@pytest.mark.parametrize("later, back", [(at(9, 0), True), (dt.datetime(2024, 1, 8, 23, 59), False)])
def test_returning_bounds(spark, rows, later, back):
    """Eight whole days after the midnight of the last day count as back, 7 days and 23 hours do not."""
    df = spark.createDataFrame([("u", at(1, 15)), ("u", later)], "k string, ts timestamp")
    seen = state.returning(df, ["k"], "ts")
    assert rows(seen.filter(F.col("ts") == F.lit(later)), "is_back") == [(back,)]


def test_delta_hand_case(spark, rows):
    df = spark.createDataFrame([("x", 1, 100), ("x", 2, 100), ("x", 3, 130), ("y", 1, None)],
                               "id string, n int, amount long")
    assert rows(state.delta(df, ["id"], ["n"], ["amount"])) == [("x", 1, 100), ("x", 2, 0), ("x", 3, 30), ("y", 1, 0)]


@pytest.mark.parametrize("limit", [None, 15])
def test_delta_against_a_walk(spark, rows, limit):
    records = [(key, ts, number, number % 17) for key, ts, _, number in skewed(3)]
    df = spark.createDataFrame(records, "k string, ts timestamp, n int, v long")
    heavy = skew.heavy_keys(df, ["k"], limit) if limit else None
    last, expected = {}, []
    for key, ts, number, value in sorted(records, key=lambda r: (r[1], r[2])):
        expected.append((number, value - last.get(key, 0)))
        last[key] = value
    assert rows(state.delta(df, ["k"], ["ts", "n"], ["v"], heavy), "n", "v") == sorted(expected, key=str)


def test_latest(spark, rows):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 3, "c"), ("x", 2, "b"), ("y", 1, "d")], "id string, n int, v string")
    assert rows(state.latest(df, ["id"], ["n"])) == [("x", 3, "c"), ("y", 1, "d")]


def test_delta_in_a_stream_goes_on_where_the_last_batch_ended(spark, rows, feed, tmp_path):
    def batch(*records):
        return spark.createDataFrame(records, "id string, ts timestamp, v decimal(20,2)")

    from decimal import Decimal as D
    df = feed("versions", batch(("x", at(1), D(100)), ("x", at(1, 13), D(100))), batch(("x", at(2), D(130))),
              batch(("y", at(2), D(5)), ("x", at(3), D(90)))).withWatermark("ts", "5 days")
    changed = state.delta(df, ["id"], ["ts"], ["v"])
    changed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("id", F.dayofmonth("ts"), F.col("v").cast("int"))
    assert rows(got) == [("x", 1, 0), ("x", 1, 100), ("x", 2, 30), ("x", 3, -40), ("y", 2, 5)]


def test_first_of_day_in_a_stream_forgets_old_keys(spark, rows, feed, tmp_path):
    """Keys are dropped a day after their last day; a later day counts again in any case."""
    def batch(*records):
        return spark.createDataFrame(records, "k string, ts timestamp")

    df = feed("views", batch(("u", at(1, 9)), ("u", at(1, 10))), batch(("u", at(1, 11)), ("v", at(9))),
              batch(("w", at(9))), batch(("u", at(10)), ("u", at(10, 13)))).withWatermark("ts", "5 seconds")
    firsts = state.first_of_day(df, ["k"], "ts")
    firsts.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("k", F.dayofmonth("ts"), F.hour("ts"))
    assert rows(got) == [("u", 1, 9), ("u", 10, 12), ("v", 9, 12), ("w", 9, 12)]


def test_delta_with_a_life_time_is_the_same_in_batch_and_stream(spark, rows, feed, tmp_path):
    """A version more than 30 seconds after the one before counts in full."""
    from decimal import Decimal as D

    def batch(*records):
        return spark.createDataFrame([(k, at(1) + dt.timedelta(seconds=s), D(v)) for k, s, v in records],
                                     "id string, ts timestamp, v decimal(20,2)")

    parts = [batch(("x", 0, 100), ("x", 30, 130), ("x", 61, 131)), batch(("x", 70, 140), ("y", 200, 1)),
             batch(("x", 201, 9), ("y", 205, 4))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    expected = rows(state.delta(whole, ["id"], ["ts"], ["v"], ttl="30 seconds"))
    assert [int(r[2]) for r in expected] == [100, 30, 131, 9, 9, 1, 3]
    df = feed("versions", *parts).withWatermark("ts", "5 seconds")
    state.delta(df, ["id"], ["ts"], ["v"], ttl="30 seconds").writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == expected


def test_a_streams_delta_goes_to_python_in_few_cells(spark, rows, feed, tmp_path):
    """Columns of all kinds come back as they were, late rows are left out, and a worker gets no timestamp and no cell per text."""
    from decimal import Decimal as D

    kinds = "id bigint, ts timestamp, n int, v decimal(20,2), w bigint, t string, d double, b boolean, x timestamp, a array<string>"

    def batch(*records):
        return spark.createDataFrame([(k, at(*when) if when else None, n, D(v), n * 10, text, n / 3, n % 2 == 0, at(5), [text])
                                      for k, when, n, v, text in records], kinds)

    parts = [batch((1, (3,), 1, "100.10", 'a"\\,\n'), (1, (3, 13), 2, "100.00", None), (None, (3,), 1, "7", "é")),
             batch((1, (9,), 3, "-130.55", ""), (2, (9,), 4, "0.01", "[]")), batch((1, (9, 13), 5, "1", "z")),
             # Later than the watermark: the row neither comes out nor counts as a version. One without a time does.
             batch((1, (2,), 6, "999", "late"), (None, (9, 14), 7, "9", "n"), (3, None, 8, "5", "none")),
             batch((1, (9, 15), 9, "2", "end"))]
    df = feed("kinds", *parts).withWatermark("ts", "1 day")
    plan = state.delta(df, ["id"], ["ts", "n"], ["v", "w"])
    assert plan.schema.names == df.schema.names
    plan.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    expected = state.delta(whole.filter("t IS NULL OR t <> 'late'"), ["id"], ["ts", "n"], ["v", "w"])
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(expected)
    processor = history.Delta(["id"], ["_at", "n"], whole.columns, "ts", ["v", "w"], None)
    cells = history._packed(history._dated(whole, "ts", None), ["id"], "ts", processor)
    assert cells.columns == ["_group", "_at", "_packed", "d", "b", "x", "a"]
    assert list(processor.packed) == ["id", "n", "v", "w", "t"]


def test_groups_of_keys_follow_the_session(spark, rows, feed, tmp_path):
    """A stream built with fewer groups keeps as many state rows; it gives the same."""
    first = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(at(1)).cast("timestamp").alias("ts"), "id")
    later = first.withColumn("ts", F.lit(at(2)).cast("timestamp")).withColumn("id", F.col("id") * 3)
    df = feed("grouped", first, later).withWatermark("ts", "9 days")
    with queries.key_groups(spark, 8):
        changed = state.delta(df, ["k"], ["ts"], ["id"])
    query = changed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(state.delta(first.unionByName(later), ["k"], ["ts"], ["id"]))
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 8
    assert spark.conf.get(history.GROUPS_CONF, None) is None


def test_keyed_state_is_asked_per_group_of_keys(spark, rows, feed, tmp_path):
    """Many keys of one micro-batch share calls, messages and state rows; with every group in use there are no more of them."""
    n = 2000
    first = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(at(1)).cast("timestamp").alias("ts"), "id")
    later = first.filter("id < 10").withColumn("ts", F.lit(at(2)).cast("timestamp")).unionByName(
        first.filter("id = 0").select(F.lit(None).cast("string").alias("k"), F.lit(at(2)).cast("timestamp").alias("ts"), "id"))
    before, history.GROUPS = history.GROUPS, 16
    try:
        df = feed("many", first, later).withWatermark("ts", "9 days")
        query = state.first_ever(df, "k", "ts").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        history.GROUPS = before
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == n + 1 and got.select("k").distinct().count() == n + 1
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 16
