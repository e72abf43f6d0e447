"""Routing by a configuration table: which source rows go to which sink table with which columns.

Configuration holds one row per routed table. It is measured once per join and broadcast while it is small: records
have few table names, and a shuffle by name would put most of them into a few tasks. Beyond that size the join is a
plain one over two exchanges, whose hot names AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import enrich, state, versions


def normal_type(kind: Column) -> Column:
    """A bootstrap insert counts as an insert."""
    return F.when(kind == "bootstrap-insert", F.lit("insert")).otherwise(kind)


def config_keys(by: tuple[str, ...]) -> list[str]:
    return [f"source_{name}" for name in by]


def normalise(config: DataFrame) -> DataFrame:
    if "source_type" not in config.columns:
        return config
    return config.withColumn("source_type", normal_type(F.col("source_type")))


def latest_config(
    snapshot: DataFrame, changes: DataFrame | None = None, by: tuple[str, ...] = ("table",), order: str = "ts_ms"
) -> DataFrame:
    """The configuration in force: the snapshot overlaid with a change feed (op, before, after, `order`).

    A delete removes its row, every other change replaces it.
    """
    snapshot = normalise(snapshot)
    if changes is None:
        return snapshot
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    fed = normalise(changes.select("op", F.col(order).alias("_at"), row.alias("_row")).select("op", "_at", "_row.*"))
    start = snapshot.select(F.lit("r").alias("op"), F.lit(None).cast(fed.schema["_at"].dataType).alias("_at"), "*")
    merged = state.latest(start.unionByName(fed), config_keys(by), ["_at"])
    return merged.filter("op <> 'd'").select(snapshot.columns)


def match(rows: DataFrame, config: DataFrame, by: tuple[str, ...] = ("table",)) -> DataFrame:
    """Rows with their configuration row; rows without one drop. `by` is ('table',) or ('table', 'type')."""
    matched = rows.alias("r").join(
        enrich.ready(config).alias("c"),
        on=[
            (normal_type(F.col("r.type")) if name == "type" else F.col(f"r.{name}")) == F.col(f"c.source_{name}")
            for name in by
        ],
    )
    return matched.drop(*[F.col(f"c.source_{name}") for name in by])


def config_versions(snapshot: DataFrame, changes: DataFrame, by: tuple[str, ...] = ("table",), order: str = "ts_ms"
                    ) -> DataFrame:
    """The configuration with its history: the columns of `snapshot`, `deleted`, and `valid_from` (epoch ms).

    The snapshot holds from the beginning, a change (op, before, after, `order`) from its moment; a delete is a version
    without a route.
    """
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    fed = changes.select((F.col("op") == "d").alias("deleted"), F.col(order).cast("bigint").alias("valid_from"), row.alias("_row"))
    start = snapshot.select("*", F.lit(False).alias("deleted"), F.lit(None).cast("bigint").alias("valid_from"))
    return normalise(start.unionByName(fed.select("_row.*", "deleted", "valid_from")))


def match_as_of(rows: DataFrame, history: DataFrame, by: tuple[str, ...] = ("table",), ts: str = "ts") -> DataFrame:
    """Rows with the configuration row in force at their own time (`ts`, epoch seconds); rows without one drop.

    So a replay over a change of the configuration routes each row as it was routed when it came.
    """
    keyed = rows.select("*", (F.col(ts) * 1000).alias("_ms"), *[
        (normal_type(F.col("type")) if name == "type" else F.col(name)).alias(f"source_{name}") for name in by])
    found = versions.as_of(keyed, history, config_keys(by), "_ms", "valid_from")
    kept = found.filter(F.col(versions.FOUND).isNotNull() & ~F.col(f"{versions.FOUND}.deleted"))
    names = [name for name in history.columns if name not in (*config_keys(by), "deleted", "valid_from")]
    return kept.select(*rows.columns, *[F.col(versions.FOUND)[name].alias(name) for name in names])


def prune(rows: DataFrame, columns: str = "sink_columns", mode: str = "exact") -> DataFrame:
    """Keep the keys of `data` that the configuration lists (comma-separated).

    `mode='substring'` keeps a key that occurs anywhere in the list text, so `id` also passes for `user_id`.
    """
    listed = F.col(columns)
    if mode == "exact":
        names = F.split(listed, r"\s*,\s*")
        return rows.withColumn("data", F.map_filter("data", lambda key, _: F.array_contains(names, key)))
    if mode == "substring":
        return rows.withColumn("data", F.map_filter("data", lambda key, _: F.contains(listed, key)))
    raise ValueError(f"unknown mode {mode}")
