"""Whitening of embeddings by shifted CholeskyQR: Gram passes over rows, R factors composed, then the SVD of R."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import settled, ship

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
PASSES = 8
LARGEST = float(1 << 52)
_LONG = (1 << 63) - 1
_EXACT = float(1 << 62)


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of each component; null unless all are there and finite. From LARGEST on it is an error."""
    wide = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    whole = F.transform(wide, lambda c: F.when(F.abs(c) < LARGEST, c.cast("bigint") + offset).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is {LARGEST:.0f} or more")).cast("bigint")))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return F.when(vector.isNotNull() & sound, whole)


@dataclass(frozen=True)
class Axes:
    """What the rows of one dimension are centred and projected with."""

    n: int
    sums: np.ndarray  # per dimension, Python or 64-bit integers
    kept: np.ndarray  # dimensions that vary
    projection: np.ndarray  # kept dimensions x components: eigenvectors over the roots of their eigenvalues
    explained: np.ndarray


def _deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: in 64 bits where that fits, else in Python integers."""
    most = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))))
    if most * n * 2.0 < _EXACT:
        return rows * n - sums.astype(np.int64)
    return rows.astype(object) * n - sums.astype(object)


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return _deviations(rows, n, sums).astype(np.float64) / n


def _squares(deviations: np.ndarray) -> list[int]:
    """Sum of squares per row, exact; one beyond 64 bits is an error."""
    if deviations.dtype != object and float(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", deviations, deviations).tolist()
    found = [sum(int(v) * int(v) for v in row) for row in deviations]
    if max(found, default=0) > _LONG:
        raise OverflowError("a deviation does not fit 64 bits")
    return found


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray]]:
    """Rows of batches (id, vector) by dimension: dimension, ids, integer matrix."""
    for batch in batches:
        vectors = batch.column("vector")
        lengths = np.diff(vectors.offsets.to_numpy())
        values = vectors.values.to_numpy()[vectors.offsets[0].as_py():vectors.offsets[-1].as_py()]
        ids = batch.column("id")
        for dims in np.unique(lengths).tolist():
            mine = lengths == dims
            rows = values[np.repeat(mine, lengths)].reshape(int(mine.sum()), dims)
            yield dims, ids.filter(pa.array(mine)), rows


def _totals(partial: DataFrame, exact: bool) -> dict[int, np.ndarray]:
    """Sums of the equally long arrays that tasks return per dimension (dims, part, content).

    Tasks are added up in groups of about the square root of their number, then those; one array per dimension
    reaches the driver, whose size does not depend on the number of rows.
    """
    def combine(key: tuple, table: pa.Table) -> pa.Table:
        arrays = [np.array(part, dtype=object) if exact else np.frombuffer(part) for part in (
            [[int(x) for x in text.split(",")] for text in table.column("content").to_pylist()] if exact
            else table.column("content").to_pylist())]
        total = arrays[0].copy()
        for more in arrays[1:]:
            total = total + more
        content = ",".join(map(str, total.tolist())) if exact else total.tobytes()
        return pa.table({"dims": [key[0].as_py()], "part": pa.array([0], pa.int32()), "content": [content]},
                        schema=pa.schema([("dims", pa.int32()), ("part", pa.int32()),
                                          ("content", pa.string() if exact else pa.binary())]))

    form = f"dims int, part int, content {'string' if exact else 'binary'}"
    parts = settled(partial, "partial")
    groups = max(1, round((parts.agg(F.max("part")).first()[0] or 0) ** 0.5))
    once = parts.groupBy("dims", F.pmod("part", F.lit(groups)).alias("group")).applyInArrow(
        lambda key, table: combine(key, table), form)
    found = once.groupBy("dims").applyInArrow(lambda key, table: combine(key, table), form).collect()
    read = (lambda c: np.array([int(x) for x in c.split(",")], dtype=object)) if exact else np.frombuffer
    return {row["dims"]: read(row["content"]) for row in found}


def _reduced(rows: DataFrame, add: Callable[[int, np.ndarray], np.ndarray], exact: bool) -> dict[int, np.ndarray]:
    """Per dimension the sum over all row blocks of the array that `add` makes of a block: one array per task and dimension."""
    kind = "string" if exact else "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        totals: dict[int, np.ndarray] = {}
        for dims, _, block in _groups(batches):
            found = add(dims, block)
            totals[dims] = found if dims not in totals else totals[dims] + found
        part = TaskContext.get().partitionId()
        content = [",".join(map(str, t.tolist())) if exact else np.ascontiguousarray(t).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([part] * len(totals), pa.int32()),
             pa.array(content, pa.string() if exact else pa.binary())], names=["dims", "part", "content"])

    return _totals(rows.mapInArrow(run, f"dims int, part int, content {kind}"), exact)


def _block_sums(dims: int, block: np.ndarray) -> np.ndarray:
    """Row count, then the sum per dimension, as Python integers."""
    most = max(abs(int(block.min(initial=0))), abs(int(block.max(initial=0))))
    wide = block if most * len(block) < _EXACT else block.astype(object)
    return np.array([len(block), *wide.sum(axis=0).tolist()], dtype=object)


def _through(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverses of the factors, by forward substitution on the transposed system, factor by factor."""
    q = rows
    for factor in factors:
        q = _solved(q, factor)
    return q


def _solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q R = rows for an upper triangular R, column by column."""
    q = np.empty_like(rows)
    for at in range(upper.shape[0]):
        q[:, at] = (rows[:, at] - q[:, :at] @ upper[:at, at]) / upper[at, at]
    return q


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor of the Gram matrix, shifted on the first pass and wherever it is not safely positive."""
    dims, unit = len(gram), np.finfo(float).eps / 2
    shift = 11 * (n * dims + dims * (dims + 1)) * unit * np.linalg.norm(gram, 2)
    if not first:
        shift = 11 * dims * (dims + 1) * unit * np.linalg.norm(gram, 2)
        if np.linalg.eigvalsh(gram)[0] > 100 * shift:
            return np.linalg.cholesky(gram).T
    return np.linalg.cholesky(gram + shift * np.eye(dims)).T


def fit(rows: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> dict[int, Axes]:
    """Whitening axes per dimension over rows (id, vector of integers). The number of rows does not limit it: what
    reaches the driver is one matrix of dims x dims per dimension and pass."""
    totals = _reduced(rows, _block_sums, True)
    known = {dims: (int(total[0]), total[1:]) for dims, total in totals.items() if dims}
    spread = _reduced(rows, lambda dims, block: (_centred(block, *known[dims]) ** 2).sum(axis=0) if dims else np.zeros(0), False)
    kept = {dims: np.flatnonzero(spread[dims] > 0) for dims in known}
    factors: dict[int, list[np.ndarray]] = {dims: [] for dims in known}
    open_ = {dims for dims in known if len(kept[dims])}
    for turn in range(passes):
        if not open_:
            break

        def gram(dims: int, block: np.ndarray) -> np.ndarray:
            if dims not in open_:
                return np.zeros(0)
            q = _through(_centred(block, *known[dims])[:, kept[dims]], factors[dims])
            return (q.T @ q).ravel()

        for dims, total in _reduced(rows, gram, False).items():
            if dims in open_:
                size = len(kept[dims])
                matrix = total.reshape(size, size)
                matrix = (matrix + matrix.T) / 2
                factors[dims].append(_factor(matrix, known[dims][0], turn == 0))
                if turn and np.abs(matrix - np.eye(size)).max() < 1e-12 * size:
                    open_ = open_ - {dims}
    found = {}
    for dims, (n, sums) in known.items():
        found[dims] = _axes(n, sums, kept[dims], factors[dims], components)
    return found


def _axes(n: int, sums: np.ndarray, kept: np.ndarray, factors: list[np.ndarray], components: int) -> Axes:
    if not len(kept):
        return Axes(n, sums, kept, np.zeros((0, 0)), np.zeros(0))
    whole = np.eye(len(kept))
    for factor in factors:
        whole = factor @ whole
    _, singular, turned = np.linalg.svd(whole)
    # Directions without variance come out as rounding errors.
    sound = singular > singular[0] * len(kept) * 1e-14
    values, vectors = singular[sound][:components], turned[sound][:components]
    return Axes(n, sums, kept, vectors.T * (np.sqrt(n) / values), values**2 / (singular**2).sum())


def _projected(block: np.ndarray, axes: Axes) -> np.ndarray:
    return _centred(block, axes.n, axes.sums)[:, axes.kept] @ axes.projection


def _errors(rows: DataFrame, axes: dict[int, Axes]) -> dict[int, float]:
    """Largest absolute entry of the whitened rows' covariance minus the identity, per dimension; measured on all rows."""
    def moments(dims: int, block: np.ndarray) -> np.ndarray:
        if dims not in axes:
            return np.zeros(0)
        white = _projected(block, axes[dims])
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = {}
    for dims, total in _reduced(rows, moments, False).items():
        if dims in axes and (size := axes[dims].projection.shape[1]):
            n, mean = axes[dims].n, total[:size] / axes[dims].n
            covariance = total[size:].reshape(size, size) / n - np.outer(mean, mean)
            found[dims] = float(np.abs(covariance - np.eye(size)).max())
    return found


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per remaining row and component (from 1, by falling eigenvalue): the key, component, n, deviation,
    whitened, explained, identity_error.

    Vectors become integers x = floor(scale * c) + offset; n and the sums S are exact, and rows are centred as (n * x - S) / n
    before anything is multiplied. Shifted CholeskyQR finds R of the centred rows: each pass adds up the Gram matrix of
    the rows solved by the factors so far, its Cholesky factor (shifted on the first pass) joins them, until the
    Gram matrix is the identity. The right singular vectors of the product of the factors are the components, the squared
    singular values over n their eigenvalues. A pass is one matrix of dims x dims per task, added up in two levels.

    Vectors that are null or hold null or non-finite entries are dropped. A component or deviation that 64 bits cannot express is
    an error. Directions without variance have no component: constant or dependent dimensions, fewer rows than
    dimensions. Vectors of another dimension are a table of their own, empty ones give no rows. Keys may be null or
    repeat, equal vectors count singly; of equal eigenvalues any basis is taken, the same for all rows. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    ship(vectors.sparkSession)
    rows = settled(
        vectors.select(F.col(key).cast("bigint").alias("id"), integers(F.col(vector), scale, offset).alias("vector"))
        .filter("vector IS NOT NULL"), "integers")
    axes = fit(rows, components)
    errors = _errors(rows, axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, ids, block in _groups(batches):
            if dims not in errors:
                continue
            own = axes[dims]
            size, count = own.projection.shape[1], len(block)
            squares = _squares(_deviations(block, own.n, own.sums))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                pa.array(np.full(count * size, own.n, np.int64)),
                pa.array(np.repeat(np.array(squares, np.int64), size)),
                pa.array(_projected(block, own).ravel()),
                pa.array(np.tile(own.explained, count)),
                pa.array(np.full(count * size, errors[dims])),
            ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    found = rows.mapInArrow(
        run, "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return found.withColumnRenamed("id", key)
