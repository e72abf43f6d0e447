"""The read queries served from summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from . import skew


def top_n(df: DataFrame, by: str, n: int = 10, tie: str = "shop_id", number: str = "num") -> DataFrame:
    """The n rows with the largest `by`, with a running number.

    Each task keeps its own n best rows, so the numbering at the end sees n rows only.
    """
    best = df.orderBy(F.desc(by), F.asc(tie)).limit(n)
    return best.withColumn(number, F.row_number().over(Window.orderBy(F.desc(by), F.asc(tie))))


def ranked(
    df: DataFrame, by: str, partition: tuple[str, ...] = ("stt", "edt"), tie: str = "shop_id", number: str = "num",
    heavy: skew.Heavy | None = None,
) -> DataFrame:
    """All rows numbered within their window by `by`, largest first."""
    return skew.numbered(df, list(partition), [F.asc(tie)], by, number, heavy)


def top_n_per_window(
    df: DataFrame, by: str, n: int = 10, partition: tuple[str, ...] = ("stt", "edt"), tie: str = "shop_id",
    number: str = "num",
) -> DataFrame:
    """The n best rows of each window; Spark keeps at most n per window and task before the shuffle."""
    order = Window.partitionBy(*partition).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn(number, F.row_number().over(order)).filter(F.col(number) <= n)


def of_day(df: DataFrame, day: str | None = None, column: str = "cur_date", pattern: str = times.DATE) -> DataFrame:
    """Rows of one day, today by default."""
    return df.filter(F.col(column) == times.as_of_day(day, pattern))


def total(df: DataFrame, value: str, day: str | None = None, column: str = "cur_date") -> DataFrame:
    """The sum of a column over one day."""
    return of_day(df, day, column).agg(F.sum(value).alias("total"))


def name_values(df: DataFrame, name: str, value: str, day: str | None = None, column: str = "cur_date") -> DataFrame:
    """Name/value pairs, of one day when the table has one."""
    rows = of_day(df, day, column) if day is not None else df
    return rows.select(F.col(name).alias("name"), F.col(value).alias("value"))


def envelope(
    df: DataFrame, order: str, columns: dict[str, str] | None = None, status: int = 0, msg: str = ""
) -> DataFrame:
    """A report as one JSON text {status, msg, data}; with `columns` (column -> title) in tabular form.

    For reports of bounded size, such as a top-n list: the report becomes one row. Long lists stay rows: see `lines`.
    """
    sorted_rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), F.struct(*df.columns).alias("row"))))
    rows = F.transform(sorted_rows, lambda item: item["row"])
    data: Column = rows
    if columns is not None:
        heads = F.array(*[
            F.struct(F.lit(title).alias("name"), F.lit(name).alias("id")) for name, title in columns.items()
        ])
        data = F.struct(heads.alias("columns"), rows.alias("rows"))
    body = F.struct(F.lit(status).alias("status"), F.lit(msg).alias("msg"), data.alias("data"))
    return df.agg(F.to_json(body).alias("value"))


def lines(df: DataFrame, status: int = 0, msg: str = "") -> DataFrame:
    """A report of any length as JSON lines {status, msg, data}, one per row."""
    body = F.struct(F.lit(status).alias("status"), F.lit(msg).alias("msg"), F.struct(*df.columns).alias("data"))
    return df.select(F.to_json(body).alias("value"))
