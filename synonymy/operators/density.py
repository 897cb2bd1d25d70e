"""Density of genes in the plane of the first two axes, the cluster around its peak, and how it differs from the reference's.

Genes are counted on a grid of fixed size; the kernel density is a convolution of that
grid, so its cost does not depend on the number of genes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.operators.moments import apart as _apart
from synonymy.operators.moments import moments
from synonymy.operators.multivariate import COVERED, Ordination, _distances, _robust, fit_of_reference
from synonymy.plans.relations import KEPT, Run, needs, on_spark, spark_query

GRID, SEEDS, LEVEL = 200, 0.30, 0.5
CORE_LEAST = 8
#: Bounds of the votes on selection: strong, weak.
COSINE, ONLY, APART = (0.90, 0.97), (0.05, 0.01), (0.5, 0.15)


def smoothed(counts: np.ndarray, covariance: np.ndarray, step: np.ndarray, n: float) -> np.ndarray:
    """The counts of a grid, convolved with the Gaussian kernel of that covariance."""
    at = np.arange(-GRID + 1, GRID)
    d = np.stack(np.meshgrid(at * step[0], at * step[1], indexing="ij"), axis=-1)
    inverse = np.linalg.pinv(covariance)
    kernel = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", d, inverse, d)) / (2 * math.pi * math.sqrt(max(np.linalg.det(covariance), 1e-300)) * n)
    size = 3 * GRID
    full = np.fft.irfft2(np.fft.rfft2(counts, (size, size)) * np.fft.rfft2(kernel, (size, size)), (size, size))
    return np.maximum(full[GRID - 1 : 2 * GRID - 1, GRID - 1 : 2 * GRID - 1], 0)


def densities(x: np.ndarray) -> np.ndarray:
    """``Density`` of the rows of an array at these rows."""
    n, plane = len(x), x[:, :2]
    low, high = plane.min(axis=0), plane.max(axis=0)
    pad = np.maximum((high - low) * 0.05, 1e-9)
    low, step = low - pad, (high - low + 2 * pad) / (GRID - 1)
    at = np.clip(np.rint((plane - low) / step).astype(int), 0, GRID - 1)
    counts = np.bincount(at[:, 0] * GRID + at[:, 1], minlength=GRID * GRID).reshape(GRID, GRID).astype(float)
    return smoothed(counts, np.cov(plane.T) * n ** (-1 / 3), step, n)[at[:, 0], at[:, 1]]


class Density:
    """A Gaussian kernel density (Scott's bandwidth) of rows (zs) on a grid over their range."""

    def __init__(self, rows: DataFrame):
        plane = rows.select(F.lit("").alias("grp"), F.slice("zs", 1, 2).alias("xs"))
        got = moments(plane).collect()  # one row
        self.n, s, c = _apart(got[0]["m"]) if got else (0.0, np.zeros(2), np.zeros((2, 2)))
        if self.n < 3:
            return
        covariance = (c - np.outer(s, s) / self.n) / (self.n - 1) * self.n ** (-1 / 3)
        ends = plane.agg(*[f(F.col("xs")[k]) for k in (0, 1) for f in (F.min, F.max)]).first()
        low, high = np.array([ends[0], ends[2]]), np.array([ends[1], ends[3]])
        pad = np.maximum((high - low) * 0.05, 1e-9)
        self.low, self.step = low - pad, (high - low + 2 * pad) / (GRID - 1)
        cells = plane.select(*[self.cell(F.col("xs")[k], k).alias(f"c{k}") for k in (0, 1)]).groupBy("c0", "c1").agg(F.count("*").alias("n")).collect()  # at most GRID * GRID rows
        counts = np.zeros((GRID, GRID))
        for r in cells:
            counts[r["c0"], r["c1"]] += r["n"]
        self.values = smoothed(counts, covariance, self.step, self.n)

    def cell(self, x, k: int):
        """The grid line nearest to a column."""
        return F.greatest(F.least(F.round((x - F.lit(float(self.low[k]))) / F.lit(float(self.step[k]))), F.lit(GRID - 1)), F.lit(0)).cast("int")

    def point(self, i: int, j: int) -> np.ndarray:
        return self.low + self.step * np.array([i, j])

    def peaks(self) -> list[tuple[np.ndarray, float]]:
        """(place, density) of the highest point of each connected region above half of the maximum, highest first."""
        high, seen, out = self.values > LEVEL * self.values.max(), np.zeros((GRID, GRID), bool), []
        for start in zip(*np.nonzero(high), strict=True):
            if seen[start]:
                continue
            seen[start], stack, best = True, [start], start
            while stack:
                i, j = stack.pop()
                best = max(best, (i, j), key=lambda x: self.values[x])
                for x in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                    if 0 <= x[0] < GRID and 0 <= x[1] < GRID and high[x] and not seen[x]:
                        seen[x] = True
                        stack.append(x)
            out.append((self.point(*best), float(self.values[best])))
        return sorted(out, key=lambda x: -x[1])

    def of(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The rows with the density of their grid point."""
        values, low, step = self.values, self.low, self.step

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    at = np.clip(np.rint((np.stack(b.zs.to_numpy())[:, :2] - low) / step).astype(int), 0, GRID - 1)
                    yield b[keep].assign(density=values[at[:, 0], at[:, 1]])

        kinds = dict(rows.dtypes)
        return rows.select(*dict.fromkeys([*keep, "zs"])).mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", density double")


def _coordinates(run: Run) -> tuple[Ordination, DataFrame | None]:
    o = Ordination(run)
    if not o.axes:
        return o, None
    return o, run("gene_coordinates").select("gene", "zs", "is_ref")


@needs("gene_codons", "gene_coordinates")
def dense_core(run: Run) -> DataFrame:
    """gene, density, in_core: the reference genes where they stand densest, at or above their median density; all of them for fewer than 8."""
    o, rows = _coordinates(run)
    schema = "gene long, density double, in_core boolean"
    if rows is None:
        return run.spark.createDataFrame([], schema)
    refs = rows.where("is_ref")
    field = Density(refs)
    if field.n < CORE_LEAST:
        return refs.select("gene", F.lit(None).cast("double").alias("density"), F.lit(True).alias("in_core"))
    at = field.of(refs, ["gene"])
    middle = at.agg(F.percentile("density", F.lit(0.5)).alias("middle"))
    return at.crossJoin(F.broadcast(middle)).select("gene", F.round("density", 9).alias("density"), (F.col("density") >= F.col("middle")).alias("in_core"))  # one row


def _near(rows: DataFrame, peak: np.ndarray) -> tuple[DataFrame, float]:
    """Rows with their distance to a peak in the plane, and the radius that holds the seeds."""
    off = F.sqrt(sum((F.pow(F.col("zs")[k] - float(peak[k]), 2) for k in (0, 1)), F.lit(0.0)))
    out = rows.withColumn("off", off)
    return out, out.agg(F.percentile("off", F.lit(SEEDS))).first()[0]


@needs("gene_codons", "gene_coordinates")
def density_peaks(run: Run) -> DataFrame:
    """peak, axis1, axis2, density, n_seed: peaks of all genes' density, each with the genes within the radius that holds 30 % of all."""
    o, rows = _coordinates(run)
    out = []
    if rows is not None and (field := Density(rows)).n >= 10:
        for k, (place, height) in enumerate(field.peaks(), 1):
            near, radius = _near(rows, place)
            out.append((k, float(place[0]), float(place[1]), height, near.where(F.col("off") <= radius).count()))
    return run.spark.createDataFrame(out, "peak int, axis1 double, axis2 double, density double, n_seed long")


@needs("gene_codons", "gene_coordinates", "reference_fit", "membership")
def dual_anchor(run: Run) -> DataFrame:
    """gene, distance, threshold, membership, rp_membership, category: membership in the cluster around the main peak, and in which of both clusters a gene is."""
    schema = "gene long, distance double, threshold double, membership double, rp_membership double, category string, spread double, apart double"
    o, rows = _coordinates(run)
    field = Density(rows) if rows is not None else None
    if field is None or field.n < 10:
        return run.spark.createDataFrame([], schema)
    near, radius = _near(rows, field.peaks()[0][0])
    axes = o.chosen()
    fitted, reference = _robust(near.where(F.col("off") <= radius), axes), fit_of_reference(run)
    if fitted is None or reference is None:
        return run.spark.createDataFrame([], schema)
    apart = float(np.linalg.norm(fitted[0] - reference[0]))
    middle = moments(rows.select(F.lit("").alias("grp"), F.col("zs").alias("xs"))).collect()  # one row
    n, s, _ = _apart(middle[0]["m"])
    spread = F.sqrt(F.aggregate(F.zip_with("zs", F.array(*[F.lit(float(x)) for x in s / n]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    keep = "gene long, off double, spread double"
    far = near.withColumn("spread", spread).mapInPandas(_distances(*fitted, keep), f"{keep}, distance double")
    cut = far.agg(F.percentile(F.when(F.col("off") <= radius, F.col("distance")), F.lit(COVERED)).alias("threshold"))
    out = far.crossJoin(F.broadcast(cut))  # one row
    z = F.greatest(F.least((F.col("distance") - F.col("threshold")) / F.greatest(F.col("threshold") / 5, F.lit(1e-6)), F.lit(500.0)), F.lit(-500.0))
    both = out.withColumn("membership", 1 / (1 + F.exp(z))).join(run("membership").select("gene", F.col("membership").alias("rp_membership"), F.col("in_cluster").alias("in_rp")), "gene")
    inside = F.col("distance") <= F.col("threshold")
    category = F.when(F.col("in_rp") & inside, "both").when(F.col("in_rp"), "rp_only").when(inside, "dens_only").otherwise("neither")
    return both.select("gene", "distance", "threshold", "membership", "rp_membership", category.alias("category"), "spread", F.lit(apart).alias("apart"))


@needs("dual_anchor", "grid")
def selection_votes(run: Run) -> DataFrame:
    """criterion, value, verdict, classification: three votes on how far the reference's usage is from the bulk's; two of a kind decide."""
    return run.sql(f"""SELECT criterion, round(value, 6) AS value, verdict, CASE WHEN sum(CASE WHEN verdict = 'strong' THEN 1 ELSE 0 END) OVER () >= 2 THEN 'strong' WHEN sum(CASE WHEN verdict = 'weak' THEN 1 ELSE 0 END) OVER () >= 2 THEN 'weak' ELSE 'moderate' END AS classification
  FROM (SELECT 'cosine' AS criterion, value, CASE WHEN value < {COSINE[0]} THEN 'strong' WHEN value > {COSINE[1]} THEN 'weak' ELSE 'moderate' END AS verdict FROM dual_cosine
    UNION ALL SELECT 'rp_only_share', value, CASE WHEN value > {ONLY[0]} THEN 'strong' WHEN value < {ONLY[1]} THEN 'weak' ELSE 'moderate' END FROM dual_only
    UNION ALL SELECT 'centre_separation', value, CASE WHEN value > {APART[0]} THEN 'strong' WHEN value < {APART[1]} THEN 'weak' ELSE 'moderate' END FROM dual_apart) x WHERE value IS NOT NULL""")


on_spark("dual_rscu", """SELECT side, codon, n * ffold / nullif(sum(n) OVER (PARTITION BY side, family), 0) AS rscu FROM (SELECT d.side, g.codon, g.family, g.ffold, sum(g.n) AS n FROM grid g
  JOIN (SELECT gene, 'rp' AS side FROM dual_anchor WHERE category IN ('both', 'rp_only') UNION ALL SELECT gene, 'dens' AS side FROM dual_anchor WHERE category IN ('both', 'dens_only')) d ON d.gene = g.gene GROUP BY d.side, g.codon, g.family, g.ffold) x""")
on_spark("dual_cosine", "SELECT sum(a.rscu * b.rscu) / nullif(sqrt(sum(a.rscu * a.rscu) * sum(b.rscu * b.rscu)), 0) AS value FROM dual_rscu a JOIN dual_rscu b ON b.codon = a.codon AND b.side = 'dens' WHERE a.side = 'rp'")
on_spark("dual_only", "SELECT count(CASE WHEN category = 'rp_only' THEN 1 END) / nullif(CAST(count(CASE WHEN category IN ('rp_only', 'both') THEN 1 END) AS DOUBLE), 0) AS value FROM dual_anchor")
on_spark("dual_apart", "SELECT max(apart) / nullif(percentile(spread, 0.5), 0) AS value FROM dual_anchor")
on_spark("dual_table", "SELECT gene, round(distance, 6) AS distance, round(threshold, 6) AS threshold, round(membership, 6) AS membership, round(rp_membership, 6) AS rp_membership, category FROM dual_anchor")
on_spark("dual_anchor", dual_anchor)
KEPT.add("dual_anchor")
for name, form in (("mv09_dense_core", dense_core), ("mv11_density_peaks", density_peaks), ("mv14_dual_anchor", "SELECT * FROM dual_table"), ("mv13_selection_votes", selection_votes)):
    spark_query(name, form)
