"""Small column helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY


def money(value: Column) -> Column:
    """Text or number to DECIMAL(20,2); null and unreadable values count as zero."""
    return F.coalesce(value.try_cast(MONEY), F.lit(0).cast(MONEY))


def filled(value: Column) -> Column:
    """True when a text is neither null nor empty."""
    return F.coalesce(value.cast("string") != "", F.lit(False))


def bucket(value: Column, buckets: int) -> Column:
    """A stable bucket number from 1 to `buckets`."""
    return F.pmod(F.xxhash64(value), F.lit(buckets)) + F.lit(1)


def tokens(value: Column) -> Column:
    """Distinct lower-case words of a text; runs of letters or digits are words."""
    words = F.split(F.lower(value), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.array_remove(words, ""))


def compute_once(df: DataFrame, *kept: str | Column, **computed: Column) -> DataFrame:
    """`kept` and `computed` columns, with the computed ones evaluated once per row.

    Spark pushes a filter on a computed column below the projection and there evaluates the expression again; for
    parsed JSON that doubles the work. Rows of a generator are no such case.
    """
    row = F.struct(*[value.alias(name) for name, value in computed.items()])
    return df.select(*kept, F.inline(F.array(row)))
