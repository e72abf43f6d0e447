"""Split joins and numbering give what the plain forms give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillmart.operators import skew


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    rows = [(n, 0 if rng.random() < 0.34 else rng.randint(1, 60), rng.randint(0, 30)) for n in range(900)]
    return spark.createDataFrame(rows, "n int, k int, v int")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(0, 50)] + [(0, "second"), (7, "other")],
                                 "k int, name string")


def test_small_tables_have_no_heavy_keys(facts):
    assert not skew.heavy_keys(facts, ["k"])


def test_heavy_keys_are_those_above_the_limit(facts):
    heavy = skew.heavy_keys(facts, ["k"], 100)
    hot = facts.filter("k = 0")
    assert list(heavy.parts) == [hot.select(F.xxhash64("k")).first()[0]]
    assert list(heavy.parts.values()) == [-(-hot.count() // 100)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [10, 100])
def test_split_join(facts, names, rows, how, limit):
    heavy = skew.heavy_keys(facts, ["k"], limit)
    assert heavy
    assert rows(skew.join(facts, names, ["k"], how, spread=["n"], heavy=heavy)) == rows(facts.join(names, ["k"], how))


def test_split_join_spreads_a_heavy_key(facts, names, spark):
    heavy = skew.heavy_keys(facts, ["k"], 50)
    keys = {row.k for row in facts.select("k").distinct().collect()}
    plan = skew.join(facts, names, ["k"], spread=["n"], heavy=heavy)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and len(keys) > 1


def test_outer_joins_are_refused(facts, names):
    with pytest.raises(ValueError):
        skew.join(facts, names, ["k"], "full")


@pytest.mark.parametrize("limit", [None, 60])
def test_numbering(facts, rows, limit):
    heavy = skew.heavy_keys(facts, ["k"], limit) if limit else None
    got = skew.numbered(facts, ["k"], [F.asc("n")], "v", "num", heavy)
    wanted = facts.withColumn("num", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "n")))
    assert rows(got, "n", "num") == rows(wanted, "n", "num")


def test_previous_row_with_many_ties(facts, rows):
    """The first order column has 31 values over 300 rows of the heavy key."""
    heavy = skew.heavy_keys(facts, ["k"], 30)
    got = skew.with_previous(facts, ["k"], ["v", "n"], ["n"], heavy).select("n", F.col("_prev.n").alias("p"))
    wanted = facts.withColumn("p", F.lag("n").over(Window.partitionBy("k").orderBy("v", "n")))
    assert rows(got, "n", "p") == rows(wanted, "n", "p")


@pytest.mark.parametrize("limit", [20, 70])
def test_previous_row_where_one_instant_holds_most_rows(spark, rows, limit):
    """Two values of the first order column hold nearly all rows of the heavy key; the second column cuts them."""
    rng = random.Random(9)
    data = [(0 if n % 3 else n % 5, rng.choice([1, 5, 5, 5, 5, 7, 7, 7, rng.randint(0, 9)]), n) for n in range(700)]
    df = spark.createDataFrame(data, "k int, t int, n int")
    heavy = skew.heavy_keys(df, ["k"], limit)
    got = skew.with_previous(df, ["k"], ["t", "n"], ["n"], heavy).select("n", F.col("_prev.n").alias("p"))
    wanted = df.withColumn("p", F.lag("n").over(Window.partitionBy("k").orderBy("t", "n")))
    assert rows(got, "n", "p") == rows(wanted, "n", "p")
    chunks = skew._chunked(df, ["k"], ["t", "n"], heavy).groupBy("k", "_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] <= 2 * limit


def test_a_hot_order_is_split_by_the_engine(spark):
    """One order with a third of all lines: the detail join is split where both sides are plain exchanges."""
    from rillmart.operators import cdc
    from rillmart.plans import dwd

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(0, 20_000, 1, 8)
        order = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)

        def record(rows, table, data):
            columns = F.create_map(*[part for k, v in data.items() for part in (F.lit(k), v.cast("string"))])
            return rows.select(F.lit("shop").alias("database"), F.lit(table).alias("table"), F.lit("insert").alias("type"),
                               F.lit(5).cast("long").alias("ts"), columns.alias("data"),
                               F.lit(None).cast("map<string,string>").alias("old"))

        lines = record(ids, "order_detail", {"id": F.col("id"), "order_id": order, "sku_id": F.sha2(F.col("id").cast("string"), 256)})
        orders = record(spark.range(500), "order_info", {"id": F.col("id"), "user_id": F.col("id")})
        df = dwd.order_detail(cdc.with_row_time(lines.unionByName(orders)), "shop")
        assert df.count() == 20_000
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_ranges_of_a_key_with_very_many_parts(spark):
    """What a row carries follows the square root of the number of parts; before, each row met all cuts of its key."""
    df = spark.range(0, 6000, 1, 4).select(F.lit(0).alias("k"), (F.col("id") * 7919 % 6000).alias("v"), F.col("id").alias("n"))
    heavy = skew.heavy_keys(df, ["k"], 3)
    assert list(heavy.parts.values()) == [2000]
    got = skew.numbered(df, ["k"], [F.asc("n")], "v", "num", heavy)
    assert got.filter(F.col("num") != 6000 - F.col("v")).isEmpty() and got.count() == 6000
    seen = skew.with_previous(df, ["k"], ["v", "n"], ["v"], heavy)
    assert seen.filter(~F.col("_prev.v").eqNullSafe(F.when(F.col("v") > 0, F.col("v") - 1))).isEmpty()
    cuts = skew._cut_points(df, ["k"], "v", heavy)
    plan = skew._passed(df.withColumn(skew._HASH, F.xxhash64("k")), skew._HASH, cuts, "v", "range")
    assert cuts.select(F.size("cuts")).first()[0] > 1900
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


@pytest.mark.parametrize("equal", [False, True])
def test_passed_cuts_are_counted_exactly(spark, equal):
    """For every number of cuts, full and broken blocks alike; null and keys without cuts included."""
    lists = [(size, list(range(0, 2 * size, 2))) for size in (0, 1, 2, 3, 4, 5, 8, 9, 10, 16, 17, 25, 100)]
    cuts = spark.createDataFrame(lists, f"{skew._HASH} bigint, cuts array<int>")
    rows_ = [(size, v) for size, _ in [*lists, (7, [])] for v in [None, *range(-1, 2 * size + 2)]]
    df = spark.createDataFrame(rows_, f"{skew._HASH} bigint, v int")
    known = dict(lists)
    for size, v, found in skew._passed(df, skew._HASH, cuts, "v", "found", equal).collect():
        below = [] if v is None else [c for c in known.get(size, []) if c < v or equal and c == v]
        assert found == (len(below) if known.get(size) else None)


def test_numbering_puts_null_last(spark, rows):
    df = spark.createDataFrame([(0, n % 40 if n % 5 else None, n) for n in range(200)], "k int, v int, n int")
    got = skew.numbered(df, ["k"], [F.asc("n")], "v", "num", skew.heavy_keys(df, ["k"], 20))
    wanted = df.withColumn("num", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "n")))
    assert rows(got, "n", "num") == rows(wanted, "n", "num")


@pytest.mark.parametrize("bins", [1, 7, 65_536])
def test_heavy_keys_are_found_in_any_number_of_bins(facts, monkeypatch, bins):
    monkeypatch.setattr(skew, "BINS", bins)
    wanted = {r.h: r.n for r in facts.groupBy(F.xxhash64("k").alias("h")).agg(F.count("*").alias("n")).collect()}
    for limit in (8, 12, 100, 899):
        assert skew.heavy_keys(facts, ["k"], limit).parts == {h: -(-n // limit) for h, n in wanted.items() if n > limit}


def test_keys_are_not_counted_where_no_bin_is_full(spark, monkeypatch):
    """At first the keys of the whole table were counted, and shuffled, to find that none is heavy."""
    monkeypatch.setattr(skew, "heavy_from_counts", lambda *_: pytest.fail("keys were counted"))
    assert not skew.heavy_keys(spark.range(0, 300_000, 1, 4), ["id"], 1000)
