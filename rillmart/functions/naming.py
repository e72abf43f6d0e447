"""Column names: snake_case and camelCase."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def camel(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)


def to_snake(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: snake(name) for name in df.columns})


def to_camel(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: camel(name) for name in df.columns})
