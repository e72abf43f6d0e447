"""Tables merged by key, micro-batch by micro-batch, with reads that touch few files.

Rows lie in buckets by a hash of their key. Each micro-batch adds a tail to the buckets its keys fall into; `compact` rewrites
buckets with many tails as one base each. Which folders belong to a bucket is said by the newest manifest, a small
file that appears under its final name in one step: a reader works on one version throughout, whatever is written or compacted
meanwhile, and a micro-batch that failed before its manifest has left nothing that counts. A table has one writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state
from .upserts import BATCH

BUCKET, PART = "_bucket", "part"
BUCKETS = 64
TAILS = 8


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its number, the last micro-batch in it, and the folders with the buckets they hold."""

    version: int = 0
    batch: int | None = None
    parts: dict[str, list[int]] = field(default_factory=dict)

    def folders(self, root: str, buckets: Iterable[int] | None = None) -> list[str]:
        wanted = None if buckets is None else set(buckets)
        return [f"{root}/{PART}={name}/{BUCKET}={bucket}" for name, held in self.parts.items() for bucket in held
                if wanted is None or bucket in wanted]

    def tails(self) -> dict[int, int]:
        """Number of folders per bucket."""
        found: dict[int, int] = {}
        for held in self.parts.values():
            for bucket in held:
                found[bucket] = found.get(bucket, 0) + 1
        return found


@dataclass(frozen=True)
class MergeTable:
    """A table of `schema` below `path` with one current row per key.

    Later micro-batches win; within one, `order` decides. `combine` shortens the rows of one micro-batch and `reduce`
    all rows of a bucket, both from and to rows with the column `_batch`; by default they keep the last row per key. `codec`
    packs the files, by default the one Spark is set to.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    buckets: int = BUCKETS
    combine: Callable[[DataFrame], DataFrame] | None = None
    reduce: Callable[[DataFrame], DataFrame] | None = None
    codec: str | None = None

    # -- manifests

    def _files(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifest(self) -> Manifest:
        """The newest version."""
        folder, files = self._files()
        if not files.exists(folder):
            return Manifest()
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        versions = sorted(name for name in names if name.endswith(".json") and not name.startswith("."))
        if not versions:
            return Manifest()
        stream = files.open(self.spark._jvm.org.apache.hadoop.fs.Path(folder, versions[-1]))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _commit(self, manifest: Manifest) -> None:
        folder, files = self._files()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        final = path(folder, f"{manifest.version:020d}.json")
        draft = path(folder, f".{manifest.version:020d}-{uuid.uuid4().hex}")
        content = json.dumps({"version": manifest.version, "batch": manifest.batch, "parts": manifest.parts})
        stream = files.create(draft, False)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"version {manifest.version} of {self.path} was written by someone else")

    # -- rows

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _last(self, rows: DataFrame) -> DataFrame:
        return state.latest(rows, list(self.keys), [BATCH, *self.order])

    def _write(self, rows: DataFrame, name: str) -> list[int]:
        """Rows into one folder per bucket, in files of the size Spark advises for a task; the buckets written."""
        bucketed = rows.select(*self.schema.names, BATCH).withColumn(BUCKET, self._bucket())
        target = f"{self.path}/data/{PART}={name}"
        # Small buckets stay together, large ones are split: a task's size does not follow the number of buckets.
        dealt = bucketed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        dealt.write.mode("errorifexists").partitionBy(BUCKET).parquet(target, compression=self.codec)
        folder, files = self._files()
        held = [status.getPath().getName() for status in files.listStatus(
            self.spark._jvm.org.apache.hadoop.fs.Path(target))]
        return sorted(int(entry.split("=")[1]) for entry in held if entry.startswith(f"{BUCKET}="))

    def merge(self, rows: DataFrame, batch: int) -> None:
        """Take in one micro-batch. One that is in the table already, or an earlier one, changes nothing."""
        known = self.manifest()
        if known.batch is not None and batch <= known.batch:
            return
        numbered = rows.select(*self.schema.names, F.lit(batch).cast("bigint").alias(BATCH))
        name = f"tail-{batch:012d}-{uuid.uuid4().hex}"
        held = self._write((self.combine or self._last)(numbered), name)
        self._commit(Manifest(known.version + 1, batch, known.parts | ({name: held} if held else {})))

    def versions(self, buckets: Iterable[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Stored rows with `_batch`, of all or some buckets, as of the newest or a given version."""
        known = manifest or self.manifest()
        stored = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        folders = known.folders(f"{self.path}/data", buckets)
        if not folders:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders).select(stored.names)

    def read(self, buckets: Iterable[int] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Current rows of all or some buckets."""
        return (self.reduce or self._last)(self.versions(buckets, manifest)).drop(BATCH)

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets that hold the keys of a frame: at most as many numbers as there are buckets."""
        return sorted(row[0] for row in keys.select(self._bucket().alias(BUCKET)).distinct().collect())

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Current rows of the keys that occur in a frame; reads their buckets only."""
        wanted = keys.select(*self.keys).distinct()
        return self.read(self.touched(wanted)).join(wanted, list(self.keys), "left_semi")

    def compact(self, tails: int = TAILS) -> list[int]:
        """Rewrite buckets of `tails` folders or more as one folder each; readers see the version before or after.

        Folders that no version needs any more stay until `unused` is told to drop them. Returns the buckets rewritten.
        """
        known = self.manifest()
        grown = sorted(bucket for bucket, count in known.tails().items() if count >= tails)
        if not grown:
            return []
        name = f"base-{known.version + 1:012d}-{uuid.uuid4().hex}"
        held = self._write((self.reduce or self._last)(self.versions(grown, known)), name)
        rest = {part: [b for b in buckets if b not in grown] for part, buckets in known.parts.items()}
        parts = {part: buckets for part, buckets in rest.items() if buckets} | ({name: held} if held else {})
        self._commit(Manifest(known.version + 1, known.batch, parts))
        return grown

    def unused(self) -> list[str]:
        """Folders of the table that its newest version does not name: replaced ones and those of failed micro-batches.

        They may be deleted once no reader works on an earlier version.
        """
        named = self.manifest().parts
        _, files = self._files()
        data = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        if not files.exists(data):
            return []
        found = [status.getPath() for status in files.listStatus(data)]
        return sorted(path.toString() for path in found if path.getName().removeprefix(f"{PART}=") not in named)
