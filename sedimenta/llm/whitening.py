"""Embedding whitening by a bidiagonal qd solver.

Vectors become integers on a grid, x = floor(grid * c) + shift, so that counts, sums and
deviations are exact. The centred rows are reduced to one triangle R by a QR decomposition
of blocks: each task keeps one triangle whatever rows it reads, and triangles are joined a
few at a time. R is as wide as a vector is long. ``bidiagonal.directions`` makes it
bidiagonal by Householder reflections, finds the singular values by dqds and the directions
by twisted factorisations; the covariance is never formed from them, so small variances
keep their accuracy. Rows are then projected where they lie.

Of all rows the driver gets one number per dimension, R, and one number per pair of
components (the measured covariance of the result).

Defined cases: rows whose vector is null, or holds a null or a non-finite entry, are left
out; so are rows whose vector is not as long as most are (of equally frequent lengths, the
greatest counts). Entries too large for the grid stay at its end, 2^52. A null id, repeated
rows and other columns are rows like others. Components without variance (down to the
rounding of the decomposition) have no whitened value and are left out, so one row alone,
or copies of one, give no rows; neither does an empty table. A deviation that no long can
hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.bidiagonal import EPS, directions
from sedimenta.llm.common import staged

GRID = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Rows reduced at once.
BLOCK = 2048
# Triangles joined by one task, about.
FAN_IN = 16
LARGEST = 2.0**52


@dataclass(frozen=True)
class Whitener:
    """What the fit leaves: everything is as large as a vector, not as the table."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def kept(self) -> int:
        return len(self.values)


def on_grid(flat: np.ndarray, grid: int, shift: int) -> np.ndarray:
    return np.clip(np.floor(grid * flat.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64) + shift


def usable(embeddings: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))


def _blocks(batch: pa.RecordBatch, at: int, width: int, grid: int, shift: int) -> Iterator[np.ndarray]:
    flat = batch.column(at).flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(-1, width)
    for i in range(0, len(rows), BLOCK):
        yield on_grid(rows[i: i + BLOCK], grid, shift)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n without cancellation: the difference is an integer where longs hold it."""
    if n * float(np.abs(x).max(initial=0)) < 2.0**62:
        return (n * x - sums) / float(n)
    mean = sums // n
    return (x - mean) - (sums - mean * n) / float(n)


def _sums(vectors: DataFrame, width: int, grid: int, shift: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension; a task hands on one row per dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            for x in _blocks(batch, 0, width, grid, shift):
                n += len(x)
                # Halves of the longs, so that no partial sum wraps.
                high, low = x >> 26, x & ((1 << 26) - 1)
                total = [t + (int(h) << 26) + int(b) for t, h, b in zip(total, high.sum(axis=0), low.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_pydict({
                "dimension": list(range(width)), "n": [n] * width, "high": [t >> 32 for t in total],
                "low": [t & 0xFFFFFFFF for t in total]},
                schema=pa.schema([("dimension", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())]))

    parts = vectors.mapInArrow(work, "dimension int, n long, high long, low long")
    rows = parts.groupBy("dimension").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("dimension").collect()
    sums = [(r["high"] << 32) + r["low"] for r in rows]
    fits = all(abs(s) < 2**62 for s in sums)
    return rows[0]["n"], np.array(sums, dtype=np.int64 if fits else object)


def _triangle(stack: np.ndarray) -> np.ndarray:
    width = stack.shape[1]
    r = np.linalg.qr(stack, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def reduced(vectors: DataFrame, n: int, sums: np.ndarray, grid: int, shift: int) -> np.ndarray:
    """R of the QR decomposition of all centred rows."""
    width = len(sums)
    kind = pa.schema([("triangle", pa.list_(pa.float64()))])

    def one(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"triangle": [r.ravel()]}, schema=kind)

    def rows_to_triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for x in _blocks(batch, 0, width, grid, shift):
                c = _centred(x, n, sums).astype(np.float64)
                r = _triangle(c if r is None else np.vstack([r, c]))
        if r is not None:
            yield one(r)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for i in range(batch.num_rows):
                next_r = batch.column(0)[i].values.to_numpy().reshape(width, width)
                r = next_r if r is None else _triangle(np.vstack([r, next_r]))
        if r is not None:
            yield one(r)

    triangles = staged(vectors.mapInArrow(rows_to_triangle, "triangle array<double>"), "triangles")
    while (left := triangles.count()) > 1:
        dealt = triangles.coalesce(-(-left // FAN_IN))
        triangles = staged(dealt.mapInArrow(joined, "triangle array<double>"), "triangles")
    return np.array(triangles.first()["triangle"]).reshape(width, width)


def fit(embeddings: DataFrame, vector_col: str = "embedding", grid: int = GRID, shift: int = SHIFT,
        components: int = COMPONENTS) -> tuple[Whitener | None, DataFrame]:
    """The whitener of all usable rows (None without any), and those rows."""
    rows = usable(embeddings, vector_col)
    lengths = rows.groupBy(F.size(vector_col).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return None, rows
    width = lengths["width"]
    rows = rows.where(F.size(vector_col) == width)
    vectors = rows.select(F.col(vector_col).cast("array<double>").alias("v"))
    n, sums = _sums(vectors, width, grid, shift)
    r = reduced(vectors, n, sums, grid, shift)
    values, found = directions(r)
    real = np.sqrt(np.maximum(values, 0)) > width * EPS * np.sqrt(values.max(initial=0.0))
    kept = np.flatnonzero(real)[:components]
    # The sum of squares of R is that of the rows: the trace needs no eigenvalue.
    return Whitener(n, sums, values[kept] / n, found[:, kept], float((r * r).sum()) / n), rows


def project(rows: DataFrame, whitener: Whitener, keep: list[str], vector_col: str = "embedding",
            grid: int = GRID, shift: int = SHIFT) -> DataFrame:
    """Kept columns, deviation and whitened (a list over components) of every row."""
    n, sums, width = whitener.n, whitener.sums, len(whitener.sums)
    scaled = whitener.vectors / np.sqrt(whitener.values)
    source = rows.select(*keep, F.col(vector_col).cast("array<double>"))
    at = len(keep)

    def deviations(x: np.ndarray) -> list[int | None]:
        rough = ((n * x.astype(np.float64) - sums.astype(np.float64)) ** 2).sum(axis=1)
        if sums.dtype != object and n * float(np.abs(x).max(initial=0)) < 2.0**62 and rough.max(initial=0) < 2.0**62:
            return ((n * x - sums) ** 2).sum(axis=1).tolist()
        exact = [sum((n * a - int(s)) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, values = [], []
            for x in _blocks(batch, at, width, grid, shift):
                deviation += deviations(x)
                values.append(_centred(x, n, sums).astype(np.float64) @ scaled)
            flat = np.concatenate(values).ravel() if values else np.zeros(0)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * scaled.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(at)), pa.array(deviation, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))],
                names=[*keep, "deviation", "whitened"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:at]]
    return source.mapInArrow(work, ", ".join([*kept, "deviation long", "whitened array<double>"]))


def identity_error(projected: DataFrame, n: int, components: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on the rows.

    The centred integers n*x - S sum to zero exactly, and so do their projections: the rows
    are centred already when they are multiplied. A task hands on one row per pair.
    """
    upper = np.triu_indices(components)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper], pa.float64())],
            names=["i", "j", "total"])

    parts = projected.select("whitened").mapInArrow(work, "i int, j int, total double")
    entries = parts.groupBy("i", "j").agg((F.sum("total") / n).alias("entry"))
    worst = entries.agg(F.max(F.abs(F.col("entry") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()
    return worst[0]


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", grid: int = GRID,
           shift: int = SHIFT, components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    whitener, rows = fit(embeddings, vector_col, grid, shift, components)
    if whitener is None or not whitener.kept:
        return embeddings.where(F.lit(False)).select(
            F.col(id_col), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("long").alias("deviation"), *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")))
    projected = staged(project(rows, whitener, [id_col], vector_col, grid, shift), "whitened")
    error = identity_error(projected, whitener.n, whitener.kept)
    explained = F.array(*(F.lit(float(v / whitener.trace)) for v in whitener.values))
    return projected.select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).alias("component"), F.lit(whitener.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
