"""Every registered query against its SQL at the smallest scale, and what must not occur in any plan."""

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    return check.database(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, db, name):
    problem = check.compare(spark, db, SF_DIR, name)
    # At this scale a fixed report day may have no rows.
    assert problem in (None, "the SQL gives no rows")


@pytest.mark.parametrize("name", [name for name in NAMES if not name.startswith("stream_")])
def test_plan_has_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["latest", "first_of_day", "first_ever", "home_detail_uv", "cancels",
                                  "shop_top_per_window"])
def test_first_rows_are_cut_before_the_shuffle(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan or "row_number(), 10, Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["cart_users"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_files_of_a_streamed_table_follow_its_rows(spark, tmp_path, monkeypatch):
    """At first a streamed table was written to a fixed number of files, so a task's input grew with the table."""
    from rillmart.testbed import stream_queries

    monkeypatch.setattr(stream_queries, "_ROWS", 100)
    rows = spark.range(1000)
    arriving = stream_queries._arriving(spark, rows, str(tmp_path / "in"), batches=2, files=4)
    assert len(spark.read.parquet(str(tmp_path / "in")).inputFiles()) == 10
    seen = []
    arriving.writeStream.foreachBatch(lambda part, _: seen.append(part.count())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 2 and sum(seen) == 1000


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """At first a bucket was one task, whatever it held."""
    from rillmart.sinks import merge_tables

    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
                "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        table = merge_tables.MergeTable(spark, str(tmp_path / "t"), rows.schema, ("id",), buckets=1)
        table.merge(rows.repartition(8), 0)
        assert len(table.versions().inputFiles()) > 1
        assert table.read().exceptAll(rows).isEmpty() and table.read().count() == 20_000
        assert table.compact(tails=1) == [0] and table.read().count() == 20_000
        assert len(table.versions().inputFiles()) > 1
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
