"""Packing of token sequences by harmonic classes, each filled with a fixed number of pieces per bin."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import ship
from .token_files import encoder_of

CAPACITY = 2048
SLACK = 8
_TASK = 1 << 40  # sequence numbers of one task


@lru_cache(maxsize=4)
def class_sizes(capacity: int, slack: int) -> tuple[int, ...]:
    """Piece lengths, rising: reciprocals of the capacity, rounded down, of which whole bins leave at most `slack` tokens free,
    and the powers of two."""
    whole = {capacity // count for count in range(1, capacity + 1)}
    exact = {size for size in whole if capacity - capacity // size * size <= slack}
    return tuple(sorted(exact | {1 << bit for bit in range(capacity.bit_length())}))


@lru_cache(maxsize=4)
def cuts(capacity: int, slack: int) -> tuple[tuple[int, ...], ...]:
    """For each length below the capacity the fewest class sizes that make it up, the largest first."""
    found: list[tuple[int, ...]] = [()]
    sizes = class_sizes(capacity, slack)
    for length in range(1, capacity):
        best = min((size for size in sizes if size <= length), key=lambda size: (len(found[length - size]), -size))
        found.append((best, *found[length - best]))
    return tuple(tuple(sorted(sizes, reverse=True)) for sizes in found)


def _powers(number: int) -> list[int]:
    """The powers of two that make up a number, the largest first."""
    return [1 << bit for bit in range(number.bit_length() - 1, -1, -1) if number >> bit & 1]


class Packer:
    """Bins of one task. A class has one open bin; a piece is (key, start, ids, length of its document)."""

    def __init__(self, capacity: int, slack: int, first: int):
        self.capacity, self.cuts = capacity, cuts(capacity, slack)
        self.open: dict[int, list[tuple]] = {}
        self.next = first
        self.out: list[tuple] = []

    def add(self, key, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self._put((key, start, ids[start:start + self.capacity], total))
            start += self.capacity
        for size in self.cuts[total - start]:
            self._put((key, start, ids[start:start + size], total))
            start += size

    def _put(self, piece: tuple) -> None:
        size = len(piece[2])
        held = self.open.setdefault(size, [])
        held.append(piece)
        if len(held) == self.capacity // size:
            self._close(self.open.pop(size))

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for key, start, ids, total in pieces:
            self.out.append((key, start, ids.tobytes(), total, self.next, at))
            at += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Open bins: pieces are cut to powers of two, and of each such class powers of two make a sequence."""
        rest, self.open = self.open, {}
        for pieces in rest.values():
            for key, start, ids, total in pieces:
                at = 0
                for size in _powers(len(ids)):
                    self._put((key, start + at, ids[at:at + size], total))
                    at += size
        for size in sorted(self.open):
            pieces, at = self.open[size], 0
            for count in _powers(len(pieces)):
                self._close(pieces[at:at + count])
                at += count
        self.open = {}


def pack(docs: DataFrame, vocabulary: str, end: int | None, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """One row per piece: the key, start (ids of its document before it), ids (little-endian, 32 bits each), doc_tokens,
    sequence_id, offset.

    Each text is encoded and `end` (if any) appended. What fills whole sequences is cut off first, the rest is cut
    into as few pieces as possible whose lengths are classes: reciprocals of the capacity, rounded down. A bin of the class
    capacity // k takes exactly k pieces and leaves at most `slack` tokens free, whatever else there is. So tasks pack
    independently, in one pass over their rows and without any shuffle; a task holds one open bin per class. Bins still open at its
    end are cut into powers of two, which make sequences whose lengths are powers of two and need no padding.

    Sequence ids are unique, rising within a task and not gapless over tasks. They follow the partitions and the order of the rows in them, so
    `docs` should be read from storage, where a task that runs again meets the same rows. Null texts are empty; an
    empty text is its end id alone, or no piece without one. Very long texts are cut as any other. Keys may be null or
    repeat: each row is a document of its own. An empty table gives no rows. Other columns are ignored, whatever
    their names.
    """
    ship(docs.sparkSession)
    kind = to_arrow_type(docs.schema[key].dataType)
    tail = np.array([] if end is None else [end], "<u4")

    def table(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces)) if pieces else [()] * 6
        types = [kind, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["key", "start", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(vocabulary), Packer(capacity, slack, TaskContext.get().partitionId() * _TASK)
        for batch in batches:
            for known, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(known, np.concatenate([encoder(content), tail], dtype="<u4"))
            yield table(packer.out)
            packer.out = []
        packer.finish()
        yield table(packer.out)

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    name = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(
        run, f"key {name}, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return found.withColumnRenamed("key", key)


def sequences(pieces: DataFrame, pad: int, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids array, padding) from the pieces of `pack`: pieces in order of their offset, then `pad`.

    A sequence whose length is a power of two is not padded. At most `capacity` pieces meet in a row.
    """
    joined = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))), lambda p: p["ids"]), "")
    whole = pieces.groupBy("sequence_id").agg(joined.alias("all"))
    used = F.length("all") / 8
    missing = F.when(F.bit_count(used.cast("bigint")) == 1, 0).otherwise(F.lit(capacity) - used).cast("int")

    def number(at: Column) -> Column:
        part = [F.substring(F.col("all"), at * 8 + 2 * i + 1, F.lit(2)) for i in (3, 2, 1, 0)]
        return F.conv(F.concat(*part), 16, 10).cast("int")

    ids = F.transform(F.sequence(F.lit(0), used.cast("int") - 1), number)
    return whole.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad), missing)).alias("ids"), missing.alias("padding"))
