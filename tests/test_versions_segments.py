"""Versions in force at a row's time, cuts by a dictionary, bitmaps and idle inputs, on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import bitmaps, keywords, routing, segments, skew, versions, windows
from rillmart.sinks import tables
from rillmart.streaming import queries

VERSIONS = [("a", 10, 1, "a10"), ("a", 20, 1, "early"), ("a", 20, 2, "a20"), ("b", None, 1, "b0"), ("b", 5, 1, "b5"), (None, 1, 1, "no")]
ROWS = [(1, "a", 9), (2, "a", 10), (3, "a", 19), (4, "a", 20), (5, "a", 99), (6, "b", 4), (7, "b", 5), (8, "c", 5), (9, None, 5),
        (10, "a", None), (11, "a", 20), (11, "a", 20)]
WANTED = [(1, None), (2, "a10"), (3, "a10"), (4, "a20"), (5, "a20"), (6, "b0"), (7, "b5"), (8, None), (9, None), (10, None),
          (11, "a20"), (11, "a20")]


@pytest.mark.parametrize("how", [{"few": True}, {"few": False}, {"heavy": True}, {}])
def test_versions_in_force(spark, rows, how):
    data = spark.createDataFrame(ROWS, "n int, k string, t int")
    known = spark.createDataFrame(VERSIONS, "k string, t int, seq int, name string")
    if how.get("heavy"):
        how = {"few": False, "heavy": skew.heavy_keys(data, ["k"], limit=2)}
    found = versions.as_of(data, known, ["k"], "t", "t", ("seq",), **how)
    assert found.columns == ["n", "k", "t", "_version"]
    assert rows(found.select("n", F.col("_version.name").alias("name"))) == sorted(WANTED, key=str)
    assert versions.as_of(data, known.limit(0), ["k"], "t", "t", few=how.get("few")).filter("_version IS NOT NULL").count() == 0
    assert versions.as_of(data.limit(0), known, ["k"], "t", "t", few=how.get("few")).count() == 0


def test_last_value_over_chunks(spark, rows):
    rng = random.Random(7)
    data = [(rng.choice("aab"), i, rng.choice([None, None, i])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, v int").withColumn("v", F.when(F.col("v").isNotNull(), F.struct("v")))
    plain = skew.with_last(df, ["k"], ["t"], "v", "last", skew.Heavy({}))
    cut = skew.with_last(df, ["k"], ["t"], "v", "last", skew.heavy_keys(df, ["k"], limit=30))
    assert rows(cut, "k", "t", "last.v") == rows(plain, "k", "t", "last.v")


def test_deleted_and_added_routes(spark, rows):
    start = spark.createDataFrame([("t", "bootstrap-insert", "s1", "id")], schemas.FACT_CONFIG)
    route = ("t", "insert", "s2", "id,n")
    changes = spark.createDataFrame([("u", route, route, 10_000), ("d", route, None, 20_000), ("c", None, ("u", "update", "s3", "id"), 0)],
                                    schemas.config_change(schemas.FACT_CONFIG).add("ts_ms", "long"))
    history = routing.config_versions(start, changes, ("table", "type"))
    data = spark.createDataFrame([("t", "insert", 9), ("t", "bootstrap-insert", 10), ("t", "insert", 20), ("u", "update", 1)],
                                 "table string, type string, ts long")
    got = routing.match_as_of(data, history, ("table", "type"))
    assert rows(got, "ts", "sink_table") == [(1, "s3"), (10, "s2"), (9, "s1")] or rows(got, "ts", "sink_table") == sorted(
        [(1, "s3"), (10, "s2"), (9, "s1")], key=str)


# cuts

def brute_cut(run, words):
    """Covers most characters, then fewest words, then the longest last word; by trying all ends."""
    best = [((0, 0), [])]
    for end in range(1, len(run) + 1):
        options = [(best[end - 1][0], -(1 << 30), best[end - 1][1])]
        for start in range(end):
            if run[start:end] in words:
                (covered, count), cut = best[start]
                options.append(((covered + end - start, count - 1), -start, [*cut, (start, end)]))
        score, _, cut = max(options, key=lambda o: (o[0], o[1]))
        best.append((score, cut))
    out, at = [], 0
    for start, end in best[-1][1]:
        out += [run[at:start]] * (start > at) + [run[start:end]]
        at = end
    return out + [run[at:]] * (at < len(run))


def test_cuts_by_a_dictionary(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(14)} | {"südwärts", "südwä", "rts"}
    runs = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 24))) for _ in range(150)]
    runs += ["südwärtsrts", "x" * 50, "", None, "ab" * 300, runs[0]]
    df = spark.createDataFrame([(r,) for r in runs], "run string")
    dictionary = spark.createDataFrame([(w,) for w in [*words, "", None]], "word string")
    got = {r["run"]: r["words"] for r in segments.cut_runs(df, dictionary).collect()}
    assert got == {run: brute_cut(run, words) for run in runs if run}
    assert segments.cut_runs(df, dictionary.limit(0)).filter("size(words) <> 1").count() == 0
    assert segments.cut_runs(df.limit(0), dictionary).count() == 0


def test_keywords_by_dictionary(spark, rows):
    df = spark.createDataFrame([(1, "redphone Phone"), (2, None), (3, "-"), (4, "redphone Phone"), (5, "bluered")], "id int, text string")
    dictionary = spark.createDataFrame([("red",), ("phone",)], "word string")
    assert rows(keywords.by_dictionary(df, "text", dictionary), "id", "keyword") == [
        (1, "phone"), (1, "red"), (4, "phone"), (4, "red"), (5, "blue"), (5, "red")]


# bitmaps

def test_distinct_counts_roll_up(spark, rows):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(seconds=rng.randrange(200_000)), rng.choice([None, 0, 5, 32_767, 32_768, 10**12, -7]),
             rng.choice("xy")) for _ in range(500)] + [(None, 1, "x")]
    df = spark.createDataFrame(data, "t timestamp, id long, k string")
    short = bitmaps.construct(df, "t", "5 seconds", ["k"], "id")
    day = bitmaps.counts(bitmaps.roll_up(bitmaps.roll_up(short, "1 hour", ["k"]), "1 day", []), [], "n")
    wanted = {}
    for t, id_, _ in data:
        if t is not None and id_ is not None:
            wanted.setdefault(t.date(), set()).add(id_)
    assert [r["n"] for r in day.orderBy("stt").collect()] == [len(ids) for _, ids in sorted(wanted.items())]


def test_bitmaps_take_no_more_room_than_their_ids(spark, rows):
    """Windows of one id each: a bitmap is a number, at first it was 4 KB however few ids it held."""
    start, ids = dt.datetime(2024, 1, 1), [0, 63, 64, -1, -64, -65, 2**63 - 1, -(2**63)]
    data = [(start + dt.timedelta(seconds=10 * n), id_) for n, id_ in enumerate(ids + ids)]
    short = bitmaps.construct(spark.createDataFrame(data, "t timestamp, id long"), "t", "5 seconds", [], "id")
    assert short.schema[bitmaps.BITS].dataType.simpleString() == "bigint" and short.count() == len(data)
    day = bitmaps.roll_up(short, "1 day", [])
    assert day.count() == 6
    assert [r["n"] for r in bitmaps.counts(day, [], "n").collect()] == [len(ids)]


# idle inputs

@pytest.mark.parametrize("skip, closed", [(True, ["2024-01-01 00:00:00", "2024-01-01 00:00:30"]), (False, [])])
def test_idle_inputs(spark, feed, rows, tmp_path, skip, closed):
    """One input is silent after its first row; one of its rows comes late."""
    def at(*seconds):
        return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s),) for s in seconds], "t timestamp")

    busy = feed("busy", at(1), at(31), at(70), at(71)).withWatermark("t", "5 seconds")
    idle = feed("idle", at(2)).withWatermark("t", "5 seconds")
    counted = windows.tumble(busy.unionByName(idle), "t", "30 seconds", [], [F.count(F.lit(1)).alias("n")], None, "2024-01-01")
    with queries.idle_inputs(spark, skip):
        tables.append(counted, str(tmp_path / "out"), str(tmp_path / "c"), once=True).awaitTermination()
    found = spark.read.schema(counted.schema).parquet(str(tmp_path / "out"))
    assert [r["stt"] for r in found.orderBy("stt").collect()] == closed
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
