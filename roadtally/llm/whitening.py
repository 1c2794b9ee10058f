"""Whitening of embeddings; the components come from FEAST contour integration.

Entries become integers, x = floor(256 * c).  The model is fitted on every
distinct vector once.  Tasks add up count and exact sums, then mean and centred
products of their vectors; those of neighbouring tasks are merged in a tree of
``FAN`` at a time, so that no task and not the driver holds more than a few
matrices, whose size depends on the number of dimensions alone.

The eigenvalues are located by inertia: the signs of a pivoted LDL' of the
shifted covariance tell how many lie beyond a shift.  Bisection finds a shift
below the wanted ones and cuts what is above it into intervals of few
eigenvalues each.  A Spark task takes an interval: a Gauss-Legendre quadrature
of solves with the covariance shifted along a circle around the interval
projects a random block onto its eigenvectors, Rayleigh-Ritz extracts them, and
this goes on until residuals vanish and as many are inside as the inertia says;
a block that doesn't converge is doubled.  The driver checks the sum of counts
and makes all components orthogonal to each other by one more Rayleigh-Ritz step.

Defined results: rows whose vector is null or holds a null or non-finite entry
go; shorter vectors count as filled up with zeros; components whose variance is
at most ``LEAST`` of the total are not distinguishable from none and are not
returned, so that equal vectors, or a single one, give no rows; repeated rows
and null ids each get their rows; a ``deviation`` beyond a long is null; an
empty table gives an empty result; a component's largest entry is positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

FAN = 16
#: Share of the total variance up to which an eigenvalue counts as zero.
LEAST = 1e-12
#: Eigenvalues of an interval, nodes of the quadrature on the half circle, rounds before a block grows, residual against the norm.
TOGETHER, NODES, ROUNDS, RESIDUAL = 8, 8, 12, 1e-13


def usable(vector: Column) -> Column:
    """Is there a vector without null, NaN or infinite entries?"""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrices(batches: Iterator[pa.RecordBatch], name: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as rows of a matrix."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column(batch.schema.get_field_index(name))
            yield batch, column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for _, x in matrices(batches):
            large = int(np.abs(x.astype(float)).max(initial=0)) * len(x) >= 2**62
            here = [int(s) for s in (x.astype(object) if large else x).sum(axis=0)]
            n, sums = n + len(x), here if sums is None else [a + b for a, b in zip(sums, here)]
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(-1, len(sums)), pa.int32()), "total": pa.array([n, *sums], pa.decimal128(38, 0))})

    found = {r.at: int(r.total) for r in fit.mapInArrow(add, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()}
    n = found.pop(-1, 0)
    return n, [found[k] for k in sorted(found)]


@dataclass
class Moments:
    """Count, mean and centred products; two of them merge without looking at the rows again."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return Moments(len(rows), mean, centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        n, apart = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n))


def moments(fit: DataFrame, project) -> Moments:
    """Moments of ``project(matrix)`` over all vectors."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for _, x in matrices(batches):
            here = Moments.of(project(x))
            held = here if held is None else held.merge(here)
        if held is not None:
            yield pa.RecordBatch.from_pandas(_row(TaskContext.get().partitionId(), held))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        held, at = None, int(rows["part"].min()) // FAN
        for r in rows.sort_values("part").itertuples(index=False):
            mean = np.frombuffer(r.mean)
            here = Moments(r.n, mean, np.frombuffer(r.products).reshape(len(mean), -1))
            held = here if held is None else held.merge(here)
        return _row(at, held)

    schema = "part long, n long, mean binary, products binary"
    parts = fit.mapInArrow(first, schema)
    for _ in range(2):
        parts = parts.groupBy(F.expr(f"part div {FAN}")).applyInPandas(merge, schema)
    (row,) = parts.groupBy(F.expr("0 * part")).applyInPandas(merge, schema).collect()
    mean = np.frombuffer(row.mean)
    return Moments(row.n, mean, np.frombuffer(row.products).reshape(len(mean), -1))


def _row(part: int, m: Moments) -> pd.DataFrame:
    return pd.DataFrame({"part": [part], "n": [m.n], "mean": [m.mean.tobytes()], "products": [np.ascontiguousarray(m.products).tobytes()]})


def negatives(matrix: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, by the signs of LDL' with complete pivoting."""
    a, found = np.array(matrix, float), 0
    mix = (1 + math.sqrt(17)) / 8
    while len(a):
        r = int(np.abs(np.diag(a)).argmax())
        off = np.abs(np.triu(a, 1))
        p, q = divmod(int(off.argmax()), len(a))
        if abs(a[r, r]) >= mix * off[p, q]:
            if a[r, r] == 0:
                break
            pivot = [r]
            found += a[r, r] < 0
        else:  # the largest entry is off the diagonal: a pair of eigenvalues of both signs
            pivot = [p, q]
            found += 1
        rest = np.delete(np.arange(len(a)), pivot)
        side = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivot, pivot)], side.T)
    return int(found)


def intervals(v: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold at least the largest ``components`` eigenvalues above LEAST."""
    d, least = len(v), LEAST * np.trace(v)
    beyond: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in beyond:
            beyond[shift] = d - negatives(v - shift * np.eye(d))
        return beyond[shift]

    def clear(low: float, high: float) -> float:
        """A shift near the middle that no eigenvalue touches."""
        for k in range(64):
            shift = low + (high - low) * (0.5 + (-1) ** k * k / 160)
            if above(shift * (1 - 1e-11)) == above(shift * (1 + 1e-11)):
                return shift
        return low + (high - low) / 2

    low, high = float(least), float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9)
    if not high > low:
        return []
    wanted = min(components, above(low))
    if not wanted:
        return []
    top = high
    while high - low > 0.01 * high and above(low) > wanted:
        middle = clear(low, high)
        low, high = (middle, high) if above(middle) >= wanted else (low, middle)
    out, todo = [], [(low, top)]
    while todo:
        low, high = todo.pop()
        count = above(low) - above(high)
        if count > TOGETHER and high - low > 1e-9 * top or count and high - low > 0.5 * high and low > least:
            middle = clear(low, high)
            todo += [(low, middle), (middle, high)]
        elif count:
            out.append((float(low), float(high), count))
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between low and high, and their unit eigenvectors as columns."""
    d, norm = len(v), float(np.linalg.norm(v))
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (nodes + 1))
    width = min(d, 2 * count + 4)
    while True:
        block = np.random.default_rng(seed).standard_normal((d, width))
        for _ in range(ROUNDS):
            projected = np.zeros_like(block)
            for turn, weight in zip(turns, weights):
                projected += weight / 2 * (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(d) - v, block)).real
            values, block = ritz(v, projected)
            inside = (values > low) & (values <= high)
            if inside.sum() == count:
                found = block[:, inside]
                if np.linalg.norm(v @ found - found * values[inside], axis=0).max() <= RESIDUAL * norm:
                    return values[inside], found
        if width == d:
            raise RuntimeError(f"{int(inside.sum())} of {count} eigenvalues found between {low} and {high}")
        width = min(d, 2 * width)


def ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: the best eigenpairs within the span of a block."""
    basis, _ = np.linalg.qr(block)
    inner = basis.T @ v @ basis
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    return values, basis @ turn


@dataclass
class Whitening:
    """A fitted model; ``vectors`` has a component a row."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(float) - self.mean) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n * x - sum)^2; None beyond a long."""
        most = int(np.abs(x.astype(float)).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if most * most * len(self.sums) < 2**62:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]
        return [e if e < 2**63 else None for e in exact]


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x (array of long, equally long) of the rows that remain."""
    vector = F.col(vector_col).cast("array<double>")
    kept = rows.select(F.col(id_col).alias("id"), vector.alias("v")).where(usable(F.col("v")))
    x = kept.select("id", F.transform("v", lambda c: F.floor(c * 256.0)).alias("x"))
    least, most = x.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least == most:
        return x
    return x.select("id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(most) - F.size("x"))).alias("x"))


def fit(x: DataFrame, components: int) -> Whitening | None:
    """A model of the distinct vectors of ``x``; None where there is no component."""
    spark = x.sparkSession
    listed = materialise(x.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(listed)
    if not sums:
        return None
    v = moments(listed, lambda x: x.astype(float)).products / n
    parts = intervals(v, components)
    if not parts:
        return None

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                values, vectors = feast(v, r.low, r.high, r.count)
                yield pd.DataFrame({"value": values, "vector": [u.tobytes() for u in np.ascontiguousarray(vectors.T)]})

    frame = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts), "low")
    found = frame.mapInPandas(solve, "value double, vector binary").collect()
    if len(found) != sum(count for _, _, count in parts):
        raise RuntimeError("the intervals don't hold what the inertia counts say")
    values, vectors = ritz(v, np.array([np.frombuffer(r.vector) for r in found]).T)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors.T[order]
    vectors = vectors * np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    model = Whitening(n, sums, values, vectors, float(np.trace(v)), 0.0)
    spread = moments(listed, model.project)
    model.identity_error = float(np.abs(spread.products / n - np.eye(len(values))).max())
    return model


def apply(x: DataFrame, model: Whitening, id_name: str) -> DataFrame:
    """A row for each row of ``x`` and component."""
    kind = x.schema["id"].dataType.simpleString()
    shares = (model.values / model.trace).tolist()
    k = len(shares)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, m in matrices(batches):
            rows, at = len(m), np.repeat(np.arange(len(m)), k)
            columns = {
                id_name: batch.column(0).take(pa.array(at)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                "n": pa.array(np.full(rows * k, model.n)),
                "deviation": pa.array(model.deviation(m), pa.int64()).take(pa.array(at)),
                "whitened": pa.array(model.project(m).reshape(-1)),
                "explained": pa.array(np.tile(shares, rows)),
                "identity_error": pa.array(np.full(rows * k, model.identity_error)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return x.mapInArrow(score, _schema(id_name, kind))


def _schema(id_name: str, kind: str) -> str:
    return f"`{id_name}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error."""
    x = integers(rows, id_col, vector_col)
    model = fit(x, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], _schema(id_col, x.schema["id"].dataType.simpleString()))
    return apply(x, model, id_col)
