"""The registered queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-02-01"


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def load() -> dict[str, Query]:
    from . import detail_queries, operator_queries, source_queries, stream_queries, summary_queries  # noqa: F401

    return QUERIES
