"""Change records: parsing, slicing by table, change deltas and status transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times, values
from ..schemas import ENVELOPE

INSERTS = ("bootstrap-insert", "insert")
BOOTSTRAP_MARKS = ("bootstrap-start", "bootstrap-complete")


def parse(messages: DataFrame, value: str = "value", mode: str = "drop") -> DataFrame:
    """JSON messages to envelope columns plus `row_time`.

    Unreadable messages are dropped, kept in `_corrupt` (`mode='keep'`), or end the job (`mode='fail'`).
    """
    options = {"mode": "FAILFAST"} if mode == "fail" else {}
    kept = [value] if mode == "keep" else []
    parsed = values.compute_once(messages, *kept, _e=F.from_json(value, ENVELOPE, options))
    # A document that is no object parses to a struct without any field.
    readable = F.coalesce(F.col("_e.table").isNotNull() | F.col("_e.data").isNotNull(), F.lit(False))
    columns = [F.col(f"_e.{name}") for name in ENVELOPE.names]
    if mode == "keep":
        columns.append(F.when(~readable, F.col(value)).alias("_corrupt"))
    else:
        parsed = parsed.filter(readable)
    return with_row_time(parsed.select(*columns))


def with_row_time(envelope: DataFrame) -> DataFrame:
    return envelope.withColumn("row_time", times.from_epoch(F.col("ts"), "s"))


def changes(envelope: DataFrame, database: str | None = None, skip_types: tuple[str, ...] = ()) -> DataFrame:
    """Rows that carry data, optionally of one database and without the given record types."""
    kept = envelope.filter(F.size("data") > 0)
    if database is not None:
        kept = kept.filter(F.col("database") == database)
    if skip_types:
        kept = kept.filter(~F.coalesce(F.col("type").isin(*skip_types), F.lit(False)))
    return kept


def of_table(envelope: DataFrame, table: str, database: str | None = None) -> DataFrame:
    rows = envelope.filter(F.col("table") == table)
    return rows if database is None else rows.filter(F.col("database") == database)


def project(rows: DataFrame, columns: list[str] | dict[str, str], *extra: str | Column) -> DataFrame:
    """Pick keys of `data` as columns; a dict maps the output name to the key."""
    names = columns if isinstance(columns, dict) else {name: name for name in columns}
    return rows.select(*[F.col("data")[key].alias(name) for name, key in names.items()], *extra)


def slice(
    envelope: DataFrame,
    table: str,
    columns: list[str] | dict[str, str],
    *extra: str | Column,
    types: tuple[str, ...] = INSERTS,
    database: str | None = None,
) -> DataFrame:
    """Newly inserted rows of one table as columns."""
    rows = of_table(envelope, table, database).filter(F.col("type").isin(*types))
    return project(rows, columns, *extra)


def status_transition(
    envelope: DataFrame,
    table: str,
    column: str,
    to: str,
    from_: str | None = None,
    types: tuple[str, ...] = ("bootstrap-insert",),
    database: str | None = None,
) -> DataFrame:
    """Rows that arrive at status `to`: new rows of `types` already there, and updates that changed the status.

    With `from_` the update must come from that status, otherwise from any.
    """
    before = F.col("old")[column]
    moved = before.isNotNull() if from_ is None else before == from_
    arrived = F.col("type").isin(*types) | ((F.col("type") == "update") & moved)
    return of_table(envelope, table, database).filter((F.col("data")[column] == to) & arrived)


def increases(envelope: DataFrame, table: str, column: str, database: str | None = None) -> DataFrame:
    """Inserts, and updates that raised a number, with `_change` = the number added."""
    new, old = F.col("data")[column].try_cast("bigint"), F.col("old")[column].try_cast("bigint")
    inserted = F.col("type").isin(*INSERTS)
    raised = (F.col("type") == "update") & (new > old)
    return (
        of_table(envelope, table, database)
        .filter(inserted | raised)
        .withColumn("_change", F.when(inserted, new).otherwise(new - old))
    )
