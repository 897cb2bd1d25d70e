"""Robust centre and covariance: the minimum covariance determinant by concentration steps.

From several starts of few rows each, the nearest share of all rows is kept, its moments
are the next estimate, and so on: the determinant never grows.  The best fits of
subsets of bounded size go on with all rows.  The covariance is made consistent by the
median distance, and the estimate ends as the moments of all rows within the 97.5 %
bound.  Two passes: rows beyond the bound of the first fit are left out of the second.

A group of up to ``TASK_ROWS`` rows (or as many as the caller allows) is fitted in one task.  For a larger one Spark takes
each step for all candidates at once: distances where the rows are, the kept share by a
quantile sketch, moments as sums.  Only estimates reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.llm.common import column
from synonymy.operators.moments import apart, chi_square_quantile
from synonymy.sources.shared import new_folder, written

#: Rows of a group that one task fits; beyond, by passes.
TASK_ROWS = 50_000
STARTS, CANDIDATES, SUBSET, SUBSETS, STEPS = 150, 10, 300, 5, 50
#: Share of chi-square beyond which rows are outliers, and rows below which the plain covariance is used.
OUTLIER, LEAST = 0.025, 10
#: Error of the quantile sketch: one in so many rows.
ACCURACY = 100_000


class Fit(NamedTuple):
    n: int
    centre: np.ndarray
    covariance: np.ndarray
    outliers: int


def least(axes: int) -> int:
    return max(LEAST, 2 * axes + 3)


def share(n: int) -> float:
    """The share of rows that is kept: all but two, from half to 90 %."""
    return max(0.5, min(0.9, (n - 2) / n))


def plain(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x.mean(axis=0), np.cov(x.T).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1])


def squared(x: np.ndarray, centres: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """Squared Mahalanobis distances of the rows under each fit, as (fits, rows)."""
    d = x[None] - centres[:, None]
    return np.maximum(np.einsum("cnp,cnp->cn", d @ np.linalg.pinv(covariances, rcond=1e-10, hermitian=True), d), 0)


def volumes(covariances: np.ndarray) -> np.ndarray:
    """Logarithms of the determinants, of singular ones far below all others."""
    p = covariances.shape[-1]
    return np.linalg.slogdet(covariances + 1e-12 * np.eye(p) * np.maximum(np.trace(covariances, axis1=-2, axis2=-1), 1e-12)[..., None, None])[1]


def concentrated(x: np.ndarray, centres: np.ndarray, covariances: np.ndarray, h: int, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, covariances, log volumes) after at most that many steps, fewer where no volume shrinks any more."""
    before = np.full(len(centres), np.inf)
    for _ in range(steps):
        kept = x[np.argpartition(squared(x, centres, covariances), h - 1, axis=1)[:, :h]]
        centres = kept.mean(axis=1)
        d = kept - centres[:, None]
        covariances = d.transpose(0, 2, 1) @ d / h
        after = volumes(covariances)
        if (after >= before - 1e-12).all():
            break
        before = after
    return centres, covariances, volumes(covariances)


def _best(fits: tuple, keep: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(fits[2], kind="stable")[:keep]
    return fits[0][order], fits[1][order]


def candidates(x: np.ndarray, kept: float, keep: int = CANDIDATES) -> tuple[np.ndarray, np.ndarray]:
    """The best fits of two steps from random starts of p + 1 rows, in subsets first if there are more rows than these hold."""
    rng, p = np.random.default_rng(42), x.shape[1]
    x = x[rng.permutation(len(x))[: SUBSET * SUBSETS]]
    parts = np.array_split(x, SUBSETS) if len(x) > 2 * SUBSET else [x]
    found = []
    for part in parts:
        rows = np.stack([part[rng.choice(len(part), p + 1, replace=False)] for _ in range(STARTS // len(parts))])
        centres = rows.mean(axis=1)
        d = rows - centres[:, None]
        start = d.transpose(0, 2, 1) @ d / (p + 1)
        found.append(_best(concentrated(part, centres, start, max(p + 1, int(kept * len(part))), 2), keep))
    centres, covariances = (np.concatenate(f) for f in zip(*found, strict=True))
    return _best(concentrated(x, centres, covariances, max(p + 1, int(kept * len(x))), 2), keep)


def determinant(x: np.ndarray, kept: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The estimate from the rows of an array."""
    kept, p = kept or share(len(x)), x.shape[1]
    h, fits = max(p + 1, int(kept * len(x))), candidates(x, kept)
    if len(x) > TASK_ROWS:  # as by passes: two steps of all, one fit in memory at a time, and the best goes on
        steps = [concentrated(x, c[None], v[None], h, 2) for c, v in zip(*fits, strict=True)]
        fits = _best(tuple(np.concatenate(f) for f in zip(*steps, strict=True)), 1)
    fits = _best(concentrated(x, *fits, h, STEPS), 1)
    d = squared(x, *fits)[0]
    factor = float(np.median(d)) / chi_square_quantile(0.5, p)
    inside = x[d < max(factor, 1e-300) * chi_square_quantile(1 - OUTLIER, p)] if factor > 0 else x
    return (inside.mean(axis=0), np.cov(inside.T, ddof=0)) if len(inside) > p else (fits[0][0], fits[1][0] * max(factor, 1e-300))


def two_passes(x: np.ndarray, kept: float | None = None) -> Fit:
    """The estimate without the rows that the first one finds beyond the bound; plain moments where there are too few rows."""
    n, p = x.shape
    if n < least(p):
        return Fit(n, *plain(x), 0)
    x = x[np.lexsort(x.T)]
    centre, covariance = determinant(x, kept)
    clean = x[squared(x, centre[None], covariance[None])[0] <= chi_square_quantile(1 - OUTLIER, p)]
    if len(clean) < max(2, p + 1):
        clean = x
    return Fit(n, *(determinant(clean, kept) if len(clean) >= least(p) else plain(clean)), n - len(clean))


# ---------------------------------------------------------------- by passes
def _groups(b: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(grp, places, rows) of each group in a batch of (grp, zs)."""
    x, grp = column(b, "zs").flatten().to_numpy().reshape(b.num_rows, -1), column(b, "grp").dictionary_encode()
    at = grp.indices.to_numpy()
    for k, name in enumerate(grp.dictionary.to_pylist()):
        places = np.flatnonzero(at == k)
        yield name, places, x[places]


def _kept(rows: DataFrame, fits: dict, bounds: dict) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The moments of the rows within each fit's bound, by group: a task sends its sums, and no row of its own."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            for grp, _, x in _groups(b):
                for k, d in enumerate(squared(x, *fits[grp]) if grp in fits else ()):
                    key = f"{grp}|{k}"
                    inside = x[d <= bounds.get(key, -1.0)]
                    if len(inside):
                        sums[key] = sums.get(key, 0.0) + np.concatenate([[len(inside)], inside.sum(axis=0), (inside.T @ inside).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["grp", "m"])

    axes = next(iter(fits.values()))[0].shape[1] if fits else 0
    parts = rows.mapInArrow(partial, "grp string, m array<double>")
    got = {r["grp"]: apart(r["m"]) for r in parts.groupBy("grp").agg(F.array(*[F.sum(F.col("m")[k]) for k in range(1 + axes + axes * axes)]).alias("m")).collect()}  # a row for each fit
    out = {}
    for grp in fits:
        each = [got[f"{grp}|{k}"] for k in range(len(fits[grp][0])) if f"{grp}|{k}" in got]
        if each:
            out[grp] = np.stack([s / n for n, s, _ in each]), np.stack([c / n - np.outer(s, s) / n / n for n, s, c in each])
    return out


def _bounds(rows: DataFrame, fits: dict, kept: float) -> dict[str, float]:
    """The distance that each fit's nearest share of rows lies within."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for grp, _, x in _groups(b):
                for k, d in enumerate(squared(x, *fits[grp]) if grp in fits else ()):
                    yield pa.RecordBatch.from_arrays([pa.repeat(f"{grp}|{k}", len(d)), pa.array(d)], names=["grp", "d"])

    far = rows.mapInArrow(measured, "grp string, d double")
    return {r["grp"]: r["cut"] for r in far.groupBy("grp").agg(F.percentile_approx("d", kept, ACCURACY).alias("cut")).collect()}  # a row for each fit


def _within(rows: DataFrame, fits: dict[str, tuple[np.ndarray, np.ndarray]], bound: float) -> DataFrame:
    """The rows (grp, zs) within that squared distance of their group's fit."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            inside = np.zeros(b.num_rows, bool)
            for grp, places, x in _groups(b):
                if grp in fits:
                    inside[places] = squared(x, fits[grp][0][None], fits[grp][1][None])[0] <= bound
            yield b.filter(pa.array(inside))

    return rows.select("grp", "zs").mapInArrow(clean, "grp string, zs array<double>")


def _by_passes(rows: DataFrame, axes: int, kept: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n_"))
    some = rows.join(F.broadcast(sizes), "grp").where(F.rand(42) < 1.2 * SUBSET * SUBSETS / F.col("n_")).select("grp", "zs")  # a row for each group

    def start(b: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(b.zs.to_numpy())
        centres, covariances = candidates(x[np.lexsort(x.T)], kept)
        return pd.DataFrame({"grp": b.grp.iloc[0], "c": centres.tolist(), "v": covariances.reshape(len(centres), -1).tolist()})

    fits: dict = {}
    for r in some.groupBy("grp").applyInPandas(start, "grp string, c array<double>, v array<double>").collect():  # ten rows for each group
        c, v = fits.setdefault(r["grp"], ([], []))
        c.append(r["c"])
        v.append(np.reshape(r["v"], (axes, axes)))
    fits = {g: (np.array(c), np.array(v)) for g, (c, v) in fits.items()}
    for _ in range(2):
        fits = _kept(rows, fits, _bounds(rows, fits, kept))
    fits = {g: _best((*f, volumes(f[1])), 1) for g, f in fits.items()}
    open_ = dict(fits)
    for _ in range(STEPS):
        new = _kept(rows, open_, _bounds(rows, open_, kept))
        open_ = {g: f for g, f in new.items() if volumes(f[1])[0] < volumes(fits[g][1])[0] - 1e-9}
        fits |= open_
        if not open_:
            break
    middle = chi_square_quantile(0.5, axes)
    bounds = {k: max(cut / middle, 1e-300) * chi_square_quantile(1 - OUTLIER, axes) for k, cut in _bounds(rows, fits, 0.5).items()}
    return {g: (c[0], v[0]) for g, (c, v) in _kept(rows, fits, bounds).items()}


def robust(rows: DataFrame, kept: float | None = None, task_rows: int = TASK_ROWS) -> dict[str, Fit]:
    """The two-pass estimate of each group of (grp, zs); groups are few, one for each sample or resample."""
    rows = written(rows.select("grp", "zs"), new_folder(rows.sparkSession, "robust"))
    sizes = {r["grp"]: r["count"] for r in rows.groupBy("grp").count().collect()}  # a row for each group
    large = [g for g, n in sizes.items() if n > task_rows]

    def fit(b: pd.DataFrame) -> pd.DataFrame:
        f = two_passes(np.stack(b.zs.to_numpy()), kept)
        return pd.DataFrame({"grp": b.grp.iloc[:1], "n": f.n, "c": [f.centre.tolist()], "v": [f.covariance.ravel().tolist()], "o": f.outliers})

    small = rows.where(~F.col("grp").isin(large)) if large else rows
    out = {}
    for r in small.groupBy("grp").applyInPandas(fit, "grp string, n int, c array<double>, v array<double>, o int").collect():  # a row for each group
        p = len(r["c"])
        out[r["grp"]] = Fit(r["n"], np.array(r["c"]), np.reshape(r["v"], (p, p)), r["o"])
    if large:
        many = rows.where(F.col("grp").isin(large))
        axes = many.select(F.size("zs")).first()[0]
        share_ = kept or share(min(sizes[g] for g in large))
        first = _by_passes(many, axes, share_)
        clean = _within(many, first, chi_square_quantile(1 - OUTLIER, axes))
        clean = written(clean, new_folder(rows.sparkSession, "robust"))
        inside = {r["grp"]: r["count"] for r in clean.groupBy("grp").count().collect()}  # a row for each group
        out |= {g: Fit(sizes[g], c, v, sizes[g] - inside[g]) for g, (c, v) in _by_passes(clean, axes, share_).items()}
    return out
