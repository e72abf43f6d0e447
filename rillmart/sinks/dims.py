"""Dimension tables kept as change logs, one folder per dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import dim
from . import merge_tables, upserts

CHANGES = T.StructType([
    T.StructField("sink_table", T.StringType()),
    T.StructField("row_key", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
])


def append(rows: DataFrame, path: str, batch: int) -> None:
    """Write one micro-batch of `plans.dim.changes`."""
    upserts.append(rows, path, batch, partition=["sink_table"])


def read(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """One dimension in its current state; reads that dimension's folders only. `row_key` is its key."""
    changes = upserts.versions(spark, path, CHANGES).filter(F.col("sink_table") == table)
    return dim.snapshot(changes, columns, (upserts.BATCH, "ts"))


def reduced(changes: DataFrame) -> DataFrame:
    """What readers still see of all dimensions, as changes with `_batch`.

    Of each cell the last filled value stays, with its batch and moment; of each row its last change, even without
    cells. What a delete removed goes, and so does the delete. Cells of one row and moment become one change again.
    """
    key, moment = ["sink_table", "row_key"], F.struct(upserts.BATCH, "ts")
    deletes = changes.filter("type = 'delete'").groupBy(*key).agg(F.max(moment).alias("deleted"))
    filled = F.map_entries(F.map_filter(F.coalesce("data", F.create_map().cast("map<string,string>")),
                                        lambda _, value: value.isNotNull()))
    # The entry without a name stands for the row itself.
    row = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    cells = changes.filter("type <> 'delete'").select(*key, moment.alias("at"), F.explode(F.concat(row, filled)).alias("c"))
    last = cells.groupBy(*key, F.col("c.key").alias("cell")).agg(
        F.max(F.struct("at", F.col("c.value").alias("value"))).alias("last"))
    kept = last.join(deletes, [last[name].eqNullSafe(deletes[name]) for name in key], "left").filter(
        F.col("deleted").isNull() | (F.col("last.at") > F.col("deleted")))
    entry = F.when(F.col("cell").isNotNull(), F.struct("cell", "last.value"))
    merged = kept.groupBy(*[last[name] for name in key], F.col("last.at").alias("at")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("data"))
    return merged.select(*key, F.lit("update").alias("type"), "at.ts", "data", f"at.{upserts.BATCH}")


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write what readers still see of all dimensions to the new folder `target`; later batches may follow there."""
    rows = reduced(upserts.versions(spark, path, CHANGES))
    # Spread by row, so that no batch or dimension lands in one task.
    rows.hint("rebalance").write.partitionBy(upserts.BATCH, "sink_table").mode("errorifexists").parquet(target)


def merge_table(spark: SparkSession, path: str, buckets: int = merge_tables.BUCKETS) -> merge_tables.MergeTable:
    """All dimensions as one merge table of their changes by dimension and row key."""
    return merge_tables.MergeTable(spark, path, CHANGES, ("sink_table", "row_key"), ("ts",), buckets,
                                   combine=lambda rows: rows, reduce=reduced)


def current(table: merge_tables.MergeTable, name: str, columns: list[str], row_keys: DataFrame | None = None) -> DataFrame:
    """One dimension of a merge table in its current state; with `row_keys` (column `row_key`) those rows alone, read from
    the buckets they lie in."""
    wanted = None if row_keys is None else row_keys.select(F.lit(name).alias("sink_table"), "row_key").distinct()
    changes = table.versions(None if wanted is None else table.touched(wanted)).filter(F.col("sink_table") == name)
    if wanted is not None:
        changes = changes.join(wanted, ["sink_table", "row_key"], "left_semi")
    return dim.snapshot(changes, columns, (upserts.BATCH, "ts"))
