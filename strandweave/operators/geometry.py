"""Fits that need linear algebra, on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turned(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The proper rotation of a decomposition."""
    return v.T @ np.diag([1.0, 1.0, np.sign(np.linalg.det(v.T @ u.T))]) @ u.T


def kabsch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rotation that turns the rows of ``a`` onto ``b`` best."""
    u, _, v = np.linalg.svd(a.T @ b)
    return turned(u, v)


def umeyama(a: np.ndarray, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Scale, rotation and shift that take ``a`` onto ``b`` best."""
    ma, mb = a.mean(0), b.mean(0)
    r = kabsch(a - ma, b - mb)
    spread = ((a - ma) ** 2).sum()
    k = float(np.trace(r @ (a - ma).T @ (b - mb)) / spread) if spread > 0 else 1.0
    return k, r, mb - k * r @ ma


def covariance(df: DataFrame, by: str, a: str, b: str) -> DataFrame:
    """by, n, c (the nine sums of products of a's and b's coordinates, row by row) and spread (the sum of both's squares)."""
    product = [F.sum(F.col(a)[i] * F.col(b)[j]) for i in range(3) for j in range(3)]
    squares = sum((F.col(x)[i] * F.col(x)[i] for x in (a, b) for i in range(3)), F.lit(0.0))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.array(*product).alias("c"), F.sum(squares).alias("spread"))


def fit_rotations(df: DataFrame, by: str, a: str, b: str) -> DataFrame:
    """The best rotation of ``a``'s points onto ``b``'s and its residual for each ``by``: by, r (nine numbers), rmse.

    All that is needed of a group are the sums of ``covariance``, which are
    gathered in the JVM; one row for each group is decomposed.
    """
    kind = df.schema[by].dataType.simpleString()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rotations, errors = [], []
            for n, c, spread in zip(rows["n"], rows["c"], rows["spread"], strict=True):
                c = np.asarray(c, float).reshape(3, 3)
                u, s, v = np.linalg.svd(c)
                s[2] *= np.sign(np.linalg.det(v.T @ u.T))
                rotations.append(turned(u, v).ravel().tolist())
                errors.append(float(np.sqrt(max(spread - 2 * s.sum(), 0.0) / n)))
            yield pd.DataFrame({by: rows[by], "r": rotations, "rmse": errors})

    return covariance(df, by, a, b).mapInPandas(fit, f"{by} {kind}, r array<double>, rmse double")


def similarity_residuals(df: DataFrame, by: str, a: str, b: str, points: int) -> DataFrame:
    """The mean pixel distance per row after the best similarity of ``a``'s points onto ``b``'s (flat, three numbers a point)."""
    kind = df.schema[by].dataType.simpleString()

    def residuals(batches):
        for rows in batches:
            out = []
            for x, y in zip(rows[a], rows[b], strict=True):
                p, q = np.asarray(x, float).reshape(points, 3), np.asarray(y, float).reshape(points, 3)
                k, r, t = umeyama(p, q)
                out.append(float(np.linalg.norm((k * (r @ p.T)).T + t - q, axis=1).mean()))
            yield pd.DataFrame({by: rows[by], "residual": out})

    return df.select(by, a, b).mapInPandas(residuals, f"{by} {kind}, residual double")
