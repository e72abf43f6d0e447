"""Entry checks of the summary jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times, values


def require(df: DataFrame, *keys: str, unit: str = "s", ts: str = "ts") -> DataFrame:
    """Rows with all `keys` filled and a positive time, with event time `et` from the epoch column."""
    usable = F.coalesce(F.col(ts) > 0, F.lit(False))
    for key in keys:
        usable = usable & values.filled(F.col(key))
    return df.filter(usable).withColumn("et", times.from_epoch(F.col(ts), unit))


def with_event_time(df: DataFrame, column: str = "create_time", zone: str | None = None) -> DataFrame:
    """Event time from a date-time text; rows without a readable one are dropped."""
    return df.withColumn("et", times.parse(F.col(column), times.DATE_TIME, zone)).filter(F.col("et").isNotNull())
