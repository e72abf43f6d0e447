"""Writing summary rows to tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..streaming import queries


def append(df: DataFrame, path: str, checkpoint: str, once: bool = False, partition: list[str] | None = None
           ) -> StreamingQuery:
    """Append a stream to a parquet table; Spark's file sink commits each batch exactly once."""
    writer = queries.writer(df, checkpoint, once).format("parquet").option("path", path)
    return (writer.partitionBy(*partition) if partition else writer).start()


def jdbc_append(url: str, table: str, columns: list[str], **options: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch function that inserts `columns`, in this order, into a database table (at least once)."""

    def apply(rows: DataFrame, batch: int) -> None:
        rows.select(*columns).write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()

    return apply


SHOP_COLUMNS = ["stt", "edt", "cur_date", "amount", "shop_id", "shop_name"]


def console(df: DataFrame, checkpoint: str, once: bool = False, rows: int = 20) -> StreamingQuery:
    return queries.writer(df, checkpoint, once).format("console").option("numRows", rows).start()
