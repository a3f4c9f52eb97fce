"""Least squares from one aggregate: sums of products per group, solved on the driver.

Only the sums leave the executors: for ``p`` terms, ``p * (p + 1) / 2`` numbers per group.
Leaving out a fold is a subtraction of sums, so cross-fitting needs no further pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Aggregates per job; more terms take more passes, not wider ones.
_PER_PASS = 300


def gram(df: DataFrame, terms: Sequence[Column], by: Sequence[str] = ()) -> dict[tuple, np.ndarray]:
    """``{group: sum of term_i * term_j}``.  ``by`` holds folds or arms, so few groups."""
    by = list(by)
    named = [t.cast("double").alias(f"v{i}") for i, t in enumerate(terms)]
    rows = df.select(*by, *named)
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    out: dict[tuple, np.ndarray] = {}
    for at in range(0, len(pairs), _PER_PASS):
        part = pairs[at:at + _PER_PASS]
        sums = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{i}_{j}") for i, j in part]
        for row in rows.groupBy(*by).agg(*sums).collect():
            matrix = out.setdefault(tuple(row[c] for c in by), np.zeros((len(terms),) * 2))
            for i, j in part:
                matrix[i, j] = matrix[j, i] = row[f"s{i}_{j}"] or 0.0
    return out


def solve(matrix: np.ndarray, xs: Sequence[int], y: int, ridge: float = 0.0) -> np.ndarray:
    """Coefficients of ``y`` on the terms ``xs``; dependent terms share their weight."""
    a = matrix[np.ix_(xs, xs)] + ridge * np.eye(len(xs))
    return np.linalg.lstsq(a, matrix[list(xs), y], rcond=1e-12)[0]


@dataclass(frozen=True)
class Scaling:
    """Centres and scales, which keep the sums of products well conditioned."""

    centre: dict[str, float]
    scale: dict[str, float]


def scaled_gram(df: DataFrame, columns: Sequence[str], by: Sequence[str]
                ) -> tuple[dict[tuple, np.ndarray], Scaling]:
    """``{group: sums of products of 1 and the scaled columns}``, and the scaling.

    One pass: each group gives its means and its products about them, which lose no digits
    however far a column lies from 0; both are moved to the common mean on the driver.
    """
    by, size = list(by), len(columns)
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found: dict[tuple, tuple[int, np.ndarray, np.ndarray]] = {}
    for at in range(0, max(len(pairs), 1), _PER_PASS):
        part = pairs[at:at + _PER_PASS]
        made = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(f"v{i}").alias(f"m{i}") for i in range(size)],
            *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in part])
        for row in made.collect():
            mean = np.array([row[f"m{i}"] or 0.0 for i in range(size)])
            n, mean, about = found.setdefault(tuple(row[c] for c in by),
                                              (row["n"], mean, np.zeros((size, size))))
            for i, j in part:
                about[i, j] = about[j, i] = n * (row[f"c{i}_{j}"] or 0.0)
    total = sum(n for n, _, _ in found.values()) or 1
    centre = sum((n * mean for n, mean, _ in found.values()), np.zeros(size)) / total
    whole = sum((about + n * np.outer(mean - centre, mean - centre)
                 for n, mean, about in found.values()), np.zeros((size, size)))
    scale = np.sqrt(np.maximum(whole.diagonal() / total, 0.0))
    scale[scale == 0] = 1.0
    out = {}
    for group, (n, mean, about) in found.items():
        off = np.concatenate([[1.0], (mean - centre) / scale])
        out[group] = n * np.outer(off, off)
        out[group][1:, 1:] += about / np.outer(scale, scale)
    return out, Scaling(dict(zip(columns, centre.tolist())), dict(zip(columns, scale.tolist())))


@dataclass(frozen=True)
class LinearFit:
    """Intercept and slopes in the units of the table."""

    intercept: float
    slopes: tuple[float, ...]
    columns: tuple[str, ...]

    def column(self) -> Column:
        out = F.lit(self.intercept)
        for name, slope in zip(self.columns, self.slopes):
            out = out + F.col(name).cast("double") * F.lit(slope)
        return out


def _unscale(beta: np.ndarray, scaling: Scaling, xs: Sequence[str], y: str) -> LinearFit:
    slopes = [float(b) * scaling.scale[y] / scaling.scale[x] for b, x in zip(beta[1:], xs)]
    at_zero = sum(s * scaling.centre[x] for s, x in zip(slopes, xs))
    intercept = scaling.centre[y] + float(beta[0]) * scaling.scale[y] - at_zero
    return LinearFit(intercept, tuple(slopes), tuple(xs))


def fit_groups(df: DataFrame, xs: Sequence[str], ys: Sequence[str], by: str,
               leave_out: bool = False) -> dict[tuple, dict[str, LinearFit]]:
    """Fits of each ``y`` on ``xs`` per group, or on all other groups with ``leave_out``."""
    return fits_of(*scaled_gram(df, [*xs, *ys], [by]), xs, ys, leave_out)


def fits_of(sums: dict[tuple, np.ndarray], scaling: Scaling, xs: Sequence[str], ys: Sequence[str],
            leave_out: bool) -> dict[tuple, dict[str, LinearFit]]:
    """The same from sums that are there: of 1, ``xs`` and ``ys``, in this order."""
    total = sum(sums.values())
    at = list(range(len(xs) + 1))
    out = {}
    for group, matrix in sums.items():
        used = total - matrix if leave_out else matrix
        out[group] = {y: _unscale(solve(used, at, len(xs) + 1 + k), scaling, xs, y)
                      for k, y in enumerate(ys)}
    return out


def per_group(fits: dict[tuple, LinearFit], by: str) -> Column:
    """The prediction of each row's own group."""
    out = None
    for (group,), fit in sorted(fits.items()):
        hit = F.col(by) == F.lit(group)
        out = F.when(hit, fit.column()) if out is None else out.when(hit, fit.column())
    return out
