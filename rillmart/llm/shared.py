"""Helpers of the operators in this package: the shared folder, settled tables, shipping of the package, words."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1000
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_own: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`, which drivers and executors share.

    Where it is unset a local session gets a folder of its own; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder shared by the whole cluster")
        root = _own.setdefault("root", tempfile.mkdtemp(prefix="rillmart-llm-"))
    return f"{root.rstrip('/')}/rillmart-llm/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet into the shared folder and read back: later uses neither recompute it nor
    depend on executors that are gone."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send the package to Python workers, which may start anywhere. Batches are kept small for long texts."""
    context = spark.sparkContext
    if _own.get("shipped") != context.applicationId:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="rillmart-ship-"), "rillmart-llm.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as packed:
            for at, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(at, name)
                        packed.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(target)
        _own["shipped"] = context.applicationId
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(size, "10000")) > ROWS_PER_BATCH:
        spark.conf.set(size, str(ROWS_PER_BATCH))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("*",)))
