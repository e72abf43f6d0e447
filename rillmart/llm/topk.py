"""Exact top-k search by inner product over a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settled, ship

K = 20
SCALE = 64
BLOCK = 32_768
QUERIES = 256
#: Quantised components stay below this, so that 64 bits hold them.
LARGEST = 1 << 62


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null where the vector is null or has a null or non-finite component.

    A finite component of LARGEST or more, times scale, is an error."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) * float(scale) < float(LARGEST))
    return F.when(vector.isNotNull() & F.coalesce(sound, F.lit(False)), F.when(fits, whole).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>")))


def _add(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps, columns[k] weighing 2^k, as slices from the lowest on, by full and half adders."""
    slices, level = [], 0
    while level < len(columns):
        here = [part for part in columns[level] if len(part)]
        maps = np.concatenate(here) if here else None
        if level + 1 == len(columns) and maps is not None and len(maps) > 1:
            columns.append([])
        while maps is not None and len(maps) > 1:
            third = len(maps) // 3
            if third:
                a, b, c = maps[:third], maps[third:2 * third], maps[2 * third:3 * third]
                half = a ^ b
                columns[level + 1].append((a & b) | (half & c))
                maps = np.concatenate([half ^ c, maps[3 * third:]])
            else:
                columns[level + 1].append((maps[:1] & maps[1:]))
                maps = maps[:1] ^ maps[1:]
        slices.append(maps[0] if maps is not None else None)
        level += 1
    zero = next((s for s in slices if s is not None), None)
    return [] if zero is None else [np.zeros_like(zero) if s is None else s for s in slices]


class Slices:
    """Candidates of one block as bitmaps, one per dimension and bit of the components (two's complement)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
        self.bits = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
        rows = len(ids)
        self.words = -(-rows // 64)
        self.all = self._pack(np.ones((1, rows), bool))[0]
        dims = vectors.shape[1]
        planes = np.zeros((2, dims, self.bits, self.words), np.uint64)
        for bit in range(self.bits):
            planes[0, :, bit] = self._pack(((self.vectors >> bit) & 1).astype(bool).T)
        planes[1] = ~planes[0] & self.all
        self.planes = planes

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(flags), self.words * 64), bool)
        padded[:, :flags.shape[1]] = flags
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of score plus a constant that makes all weights positive.

        A component is the sum of its bits, the top one weighing negatively. A bit of negative weight w counts as w
        plus |w| times its complement, so only the order-keeping constant is lost.
        """
        sizes = np.abs(query)
        top = int(sizes.max(initial=0)).bit_length() + self.bits
        columns: list[list[np.ndarray]] = [[] for _ in range(top)]
        for bit in range(self.bits):
            negative = (query < 0) ^ (bit == self.bits - 1)
            for shift in range(int(sizes.max(initial=0)).bit_length()):
                used = np.flatnonzero((sizes >> shift) & 1)
                if len(used):
                    columns[bit + shift].append(self.planes[negative[used].astype(int), used, bit])
        return _add(columns)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best k candidates but the query itself, equal scores by smaller id."""
        own = [int(np.searchsorted(self.ids, query_id, side)) for side in ("left", "right")]
        rest = self.all.copy()
        for row in range(*own):
            rest[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        sure, missing = np.zeros_like(rest), k
        for piece in reversed(self.scores(query)):
            ones = rest & piece
            count = int(np.bitwise_count(ones).sum())
            if count >= missing:
                rest = ones
            else:
                sure, rest, missing = sure | ones, rest & ~piece, missing - count
        # What is left has equal scores, in order of id.
        rows = np.concatenate([self._rows(sure), self._rows(rest)[:missing]])
        return self.ids[rows], _products(self.vectors[rows], query)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, over wider integers where sums may pass 64 bits; a product that does is an error."""
    bound = int(np.abs(vectors).max(initial=0)) * int(np.abs(query).max(initial=0)) * len(query)
    if bound < 1 << 63:
        return vectors @ query
    wide = [sum(map(int.__mul__, vector, query.tolist())) for vector in vectors.tolist()]
    if any(not -(1 << 63) <= score < 1 << 63 for score in wide):
        raise OverflowError("a score among the best does not fit 64 bits")
    return np.array(wide, np.int64)


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, at = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if at != (row.dims, row.block):
                    ids = np.frombuffer(row.ids, np.int64)
                    index, at = Slices(ids, _unpacked(row.vectors, row.kind, len(ids), row.dims)), (row.dims, row.block)
                query_ids, out = np.frombuffer(row.q_ids, np.int64), []
                queries = _unpacked(row.q_vectors, row.q_kind, len(query_ids), row.dims)
                for query_id, query in zip(query_ids.tolist(), queries):
                    ids, scores = index.top(query_id, query, k)
                    out += zip([query_id] * len(ids), ids.tolist(), scores.tolist())
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def _unpacked(content: bytes, kind: str, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(content, kind).reshape(rows, dims).astype(np.int64)


def _blocks(vectors: DataFrame, number: int, prefix: str) -> DataFrame:
    """Rows packed into `number` binary blocks by a hash of id, vector and a row number, per dimension, in the smallest fitting integers."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packed = np.stack([np.asarray(v, np.int64) for v in rows["vector"]])
        most = max(int(packed.max(initial=0)), -1 - int(packed.min(initial=0)))
        kind = next(f"<i{size}" for size in (1, 2, 4, 8) if most < 1 << 8 * size - 1)
        return pd.DataFrame([(key[0], key[1], rows["id"].to_numpy(np.int64).tobytes(), kind,
                              packed.astype(kind).tobytes())])

    dealt = vectors.withColumn("at", F.pmod(F.xxhash64("id", "vector", F.monotonically_increasing_id()), F.lit(number)).cast("int"))
    return dealt.groupBy("dims", "at").applyInPandas(
        pack, f"dims int, {prefix}block int, {prefix}ids binary, {prefix}kind string, {prefix}vectors binary")


def top_k(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """The k candidates of highest integer inner product for each row that `queries` holds for.

    Components are quantised to floor(scale * x). Returns query_id, rank from 1, vec_id, score; ties by smaller id;
    fewer rows where there are fewer candidates. Candidates are all rows with another id than the query's, of the same
    dimension. Vectors that are null or hold null or non-finite values take no part. A finite value of LARGEST or more
    (times scale), or a score among the best beyond 64 bits, is an error. Rows that repeat an id are candidates each; null ids take no part.

    Candidates lie in blocks of a bounded number of rows, each a set of bitmaps per dimension and bit. A query adds the bitmaps,
    weighted by its own components, with bitwise adders into slices of the score; from the highest slice down rows
    are kept until k are sure, and the rows at the boundary have equal scores. Query blocks meet candidate blocks, so
    work is the number of queries times the number of rows, which an exact search over all rows needs, and
    only k rows per query and block are shuffled.
    """
    ship(vectors.sparkSession)
    dense = settled(
        vectors.select(F.col(key).cast("bigint").alias("id"), quantised(F.col(vector), scale).alias("vector"),
                       queries.alias("asks"))
        .filter("id IS NOT NULL AND vector IS NOT NULL").withColumn("dims", F.size("vector")), "quantised")
    rows, asking = dense.count(), dense.filter("asks").count()
    blocks, query_blocks = max(1, -(-rows // block)), max(1, -(-asking // QUERIES))
    candidates = settled(_blocks(dense.select("id", "vector", "dims"), blocks, ""), "candidate-blocks")
    asked = settled(_blocks(dense.filter("asks").select("id", "vector", "dims"), query_blocks, "q_"), "query-blocks")
    met, parts = ["dims", "block", "q_block"], blocks * query_blocks
    found = (
        candidates.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).repartition(parts, *met)
        .join(asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(parts, *met), met)
        .mapInPandas(_search(k), "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
