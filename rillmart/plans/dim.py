"""Dimension build: change records routed by configuration to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cdc, routing


def changes(envelope: DataFrame, config: DataFrame, database: str | None = None) -> DataFrame:
    """Changes for all dimension tables: sink_table, row_key, type, ts and the listed columns in `data`.

    A configuration with history (`routing.config_versions`) routes each change by the version of its own time.
    """
    usable = cdc.changes(envelope, database, skip_types=cdc.BOOTSTRAP_MARKS)
    match = routing.match_as_of if "valid_from" in config.columns else routing.match
    matched = match(usable, config, by=("table",))
    keyed = matched.withColumn("row_key", F.expr("data[sink_row_key]"))
    return routing.prune(keyed).select("sink_table", "row_key", "type", "ts", "data")


def snapshot(rows: DataFrame, columns: list[str], order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One dimension table in its current state from its changes (`changes` filtered to one sink table).

    A change overwrites the cells it fills and leaves the others; a delete removes the row with everything written
    before it. One pass, combined before the shuffle: per cell the last filled value with its moment, per row the
    last delete. `order` must be total within a row key.
    """
    moment = F.struct(*order)
    is_delete = F.col("type") == "delete"
    put = F.when(~is_delete, moment)
    merged = rows.groupBy("row_key").agg(
        F.max(F.when(is_delete, moment)).alias("_deleted"),
        F.max(put).alias("_put"),
        *[
            F.max(F.when(~is_delete & F.col("data")[name].isNotNull(),
                         F.struct(moment.alias("at"), F.col("data")[name].alias("value")))).alias(f"_{name}")
            for name in columns
        ],
    )
    alive = F.col("_deleted").isNull() | (F.col("_put") > F.col("_deleted"))
    fresh = [
        F.when(F.col("_deleted").isNull() | (F.col(f"_{name}.at") > F.col("_deleted")), F.col(f"_{name}.value")).alias(
            name
        )
        for name in columns
    ]
    return merged.filter(F.col("_put").isNotNull() & alive).select("row_key", *fresh)
