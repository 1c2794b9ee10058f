"""Calibration of raw lengths and speeds, and yearly trends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT, DEGREE = 10_000.0, 4
PARTS = (("bas", lambda x: x < LIMIT, DEGREE), ("haut", lambda x: x >= LIMIT, 1))


def _factor(rows: np.ndarray) -> np.ndarray:
    """The triangle of a QR factorisation: all that least squares need to know of rows (powers, then the value)."""
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def _solved(triangle: np.ndarray) -> list[float]:
    """Coefficients; a power that adds nothing gets 0."""
    r, t = triangle[:, :-1], triangle[:, -1]
    c = np.linalg.lstsq(r, t, rcond=None)[0]
    return c.tolist()


def fit(df: DataFrame, raw: str, true: str, fan: int = 64) -> dict[str, list[float]]:
    """Two least-squares fits: degree 4 below ``LIMIT``, a line from it on; zeros where there are no rows.

    Tasks factor the rows of their batches, and the triangles of their batches
    together; triangles of ``fan`` tasks are factored together until one is
    left.  This is as exact as a QR factorisation of all rows, where the sums of
    powers of the normal equations would lose half of the digits.  A task holds
    a batch and some triangles of six columns.
    """
    known = df.where(F.col(true).isNotNull() & F.col(raw).isNotNull()).select(F.col(raw).cast("double").alias("z"), F.col(true).cast("double").alias("y"))
    schema = "part long, partie string, r array<array<double>>"

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {name: np.zeros((0, degree + 2)) for name, _, degree in PARTS}
        for batch in batches:
            for name, part, degree in PARTS:
                b = batch[part(batch["z"])]
                rows = np.column_stack([np.vander(b["z"].to_numpy() / LIMIT, degree + 1, increasing=True), b["y"].to_numpy()])
                held[name] = _factor(np.vstack([held[name], rows]))
        yield pd.DataFrame([(TaskContext.get().partitionId(), name, r.tolist()) for name, r in held.items() if len(r)], columns=["part", "partie", "r"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        r = _factor(np.vstack([np.array([list(x) for x in r]) for r in rows["r"]]))
        return pd.DataFrame([(int(rows["part"].min()) // fan, rows["partie"].iloc[0], r.tolist())], columns=["part", "partie", "r"])

    parts = known.mapInPandas(first, schema)
    for _ in range(2):
        parts = parts.groupBy("partie", F.expr(f"part div {fan}")).applyInPandas(merge, schema)
    found = {r["partie"]: np.array([list(x) for x in r["r"]]) for r in parts.groupBy("partie").applyInPandas(merge, schema).collect()}
    return {name: _solved(found[name]) if name in found else [0.0] * (degree + 1) for name, _, degree in PARTS}


def split(df: DataFrame, key: str, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(learning, test) rows by a hash of the key, so that reruns agree."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.where(u >= test), df.where(u < test)


def fit_quality(df: DataFrame, raw: str, true: str, predicted: str) -> DataFrame:
    """Rows, root mean square error and coefficient of determination of each part of the calibration."""
    part = F.when(F.col(raw) < LIMIT, "bas").otherwise("haut")
    y, p = F.col(true), F.col(predicted)
    g = df.where(y.isNotNull() & p.isNotNull()).groupBy(part.alias("partie"))
    return g.agg(F.count("*").alias("n"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"), (1 - F.sum((y - p) * (y - p)) / F.nullif(F.regr_syy(y, y), F.lit(0.0))).alias("r2"))


def _poly(z: Column, coefficients: list[float]) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * z + F.lit(float(c))
    return out


def apply(df: DataFrame, raw: str, model: dict[str, list[float]], name: str) -> DataFrame:
    """The calibrated value; null on rows tagged with a broken length, speed or zero code."""
    z = F.col(raw) / LIMIT
    value = F.when(F.col(raw) < LIMIT, _poly(z, model["bas"])).otherwise(_poly(z, model["haut"]))
    broken = F.arrays_overlap("fail", F.array(F.lit("longueur"), F.lit("vitesse"), F.lit("value0")))
    return df.withColumn(name, F.when(~broken, value))


def trend(df: DataFrame) -> DataFrame:
    """Linear trend of tmja by year of each counter."""
    return df.groupBy("id_comptag").agg(F.regr_slope("tmja", "annee").alias("pente"), F.regr_intercept("tmja", "annee").alias("origine"), F.count("*").alias("n"))
