"""Sums and products of vectors by group, and the chi-square distribution."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moments(rows: DataFrame, weighted: bool = False) -> DataFrame:
    """grp, m: of vectors (grp, xs[, w]) the number, the sums and the sums of products w * x * x', in one array of 1 + p + p * p."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for grp, part in batch.groupby("grp"):
                x = np.stack(part["xs"].to_numpy())
                w = part.w.to_numpy()[:, None] if weighted else 1.0
                sums[grp] = sums.get(grp, 0.0) + np.concatenate([[len(x)], x.sum(axis=0), ((x * w).T @ x).ravel()])
            if len(sums) > 2000:
                yield pd.DataFrame({"grp": list(sums), "m": [v.tolist() for v in sums.values()]})
                sums = {}
        if sums:
            yield pd.DataFrame({"grp": list(sums), "m": [v.tolist() for v in sums.values()]})

    columns = ["grp", "xs", "w"] if weighted else ["grp", "xs"]
    parts = rows.select(*columns).mapInPandas(partial, "grp string, m array<double>")
    summed = parts.select("grp", F.posexplode("m").alias("k", "v")).groupBy("grp", "k").agg(F.sum("v").alias("v"))
    return summed.groupBy("grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda e: e["v"]).alias("m"))  # 1 + p + p * p numbers a group


def apart(m: list[float]) -> tuple[float, np.ndarray, np.ndarray]:
    m = np.asarray(m)
    p = int(round((math.sqrt(4 * len(m) - 3) - 1) / 2))
    return float(m[0]), m[1 : p + 1], m[p + 1 :].reshape(p, p)


def chi_square_upper(x: np.ndarray, df: int) -> np.ndarray:
    """P(chi-square >= x): the finite sum, and erfc for odd df."""
    h = np.maximum(np.asarray(x, float), 0.0) / 2
    odd = df % 2
    total = np.array([math.erfc(math.sqrt(v)) for v in h]) if odd else np.zeros(len(h))
    with np.errstate(divide="ignore"):
        for k in range(df // 2):
            total = total + np.where(h > 0, np.exp((k + odd / 2) * np.log(h) - h - math.lgamma(k + 1 + odd / 2)), float(k == 0 and not odd))
    return np.clip(total, 0.0, 1.0)


def chi_square_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 10.0 * df + 100
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_upper(np.array([mid]), df)[0] > 1 - p else (lo, mid)
    return (lo + hi) / 2
