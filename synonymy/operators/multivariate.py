"""Ordination, distances, membership and clusters of genes and samples.

What the sizes of the input reach is done by Spark: moments are sums over all genes,
and coordinates and distances are computed where the genes are.  Only matrices over
codons (59 by 59 at most) come to one place, one for each group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.functions.codons import codon_rows
from synonymy.operators.comparisons import adjusted, kruskal, two_sample
from synonymy.operators.moments import apart as _apart
from synonymy.operators.moments import chi_square_quantile, chi_square_upper, moments
from synonymy.operators.ranking import ordered
from synonymy.operators.robust import robust
from synonymy.plans.relations import KEPT, Run, needs, on_spark, spark_query
from synonymy.sources.shared import new_folder, written

EMITTED_AXES, MOST_AXES, LEAST_AXES, INERTIA = 15, 8, 2, 90.0
#: Share of the reference's own distances that its threshold covers.
COVERED = 0.9
FLAG = 0.01
BIN, SIGMA, PROMINENCE = 30, 1.0, 0.08


def _signed(v: np.ndarray) -> np.ndarray:
    """Columns turned so that each one's largest loading is positive."""
    return v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])


# ---------------------------------------------------------------- vectors
@needs("gene_ns")
def gene_codons(run: Run) -> DataFrame:
    """gene, sample_id, genome, cond, xs: usage of the 59 codons in their order, 0 where the family is missing; whole: all independent codons are there; ind: these."""
    sense = [(k, r[7]) for k, r in enumerate(codon_rows()) if r[5]]
    some = lambda form, kept: f"array({', '.join(form.format(k) for k, indep in sense if indep or not kept)})"
    return run.sql(f"SELECT gene, sample_id, genome, cond, {some('coalesce(rs[{}], 0e0)', False)} AS xs, {some('rs[{}]', True)} AS ind, {' AND '.join(f'rs[{k}] IS NOT NULL' for k, indep in sense if indep)} AS whole FROM gene_ns")


@needs("gene_codons")
def codon_moments(run: Run) -> DataFrame:
    """grp, m: moments of all genes' usage, weighted by one over its sum; every ordination starts from them."""
    rows = run("gene_codons").select(F.lit("").alias("grp"), "xs", F.aggregate("xs", F.lit(0.0), lambda a, x: a + x).alias("total")).where("total > 1e-3").withColumn("w", 1 / F.col("total"))
    return moments(rows, weighted=True)


class Ordination:
    """Correspondence analysis of genes by codons from one pass of weighted moments."""

    def __init__(self, run: Run, least: int = 10):
        got = run("codon_moments").collect()  # one row
        self.n, self.columns, cross = _apart(got[0]["m"]) if got else (0.0, np.zeros(59), np.zeros((59, 59)))
        self.axes = 0
        if self.n < least:
            return
        self.grand = float(self.columns.sum())
        used = self.columns > 0
        scale = np.zeros(len(used))
        scale[used] = 1 / np.sqrt(self.columns[used])
        gram = (cross - np.outer(self.columns, self.columns) / self.grand) * np.outer(scale, scale)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        order = np.argsort(values)[::-1]
        self.values, vectors = np.maximum(values[order], 0), vectors[:, order]
        rank = int(min(self.n, len(used)))
        self.percent = self.values / self.values.sum() * 100
        self.stick = np.array([sum(1 / j for j in range(k, rank + 1)) / rank * 100 for k in range(1, rank + 1)])
        self.axes = max(LEAST_AXES, min(EMITTED_AXES, rank, rank - 1))
        self.vectors, self.scale = _signed(vectors[:, : self.axes]), scale

    def chosen(self) -> int:
        """Axes up to the target share of inertia, but only leading ones above the broken stick."""
        enough = int(np.searchsorted(np.cumsum(self.percent[: self.axes]), INERTIA) + 1)
        above = 0
        for seen, stick in zip(self.percent[: self.axes], self.stick, strict=False):
            if seen <= stick:
                break
            above += 1
        return max(LEAST_AXES, min(enough, max(above, LEAST_AXES), MOST_AXES, self.axes))

    def coordinates(self, run: Run, axes: int) -> DataFrame:
        """The genes with zs: their coordinates on the first axes."""
        columns, grand, scale, v = self.columns, self.grand, self.scale, self.vectors[:, :axes]

        def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    x = np.stack(b["xs"].to_numpy())
                    r = x.sum(axis=1, keepdims=True)
                    s = (x - r * columns / grand) * scale / np.sqrt(r)
                    yield b.drop(columns="xs").assign(zs=list(((s @ v) * np.sqrt(grand / r)).tolist()))

        rows = run("gene_codons").where(F.aggregate("xs", F.lit(0.0), lambda a, x: a + x) > 1e-3).select("gene", "sample_id", "genome", "cond", "xs")
        return rows.mapInPandas(project, "gene long, sample_id string, genome string, cond string, zs array<double>")


@needs("gene_codons")
def coa_inertia(run: Run) -> DataFrame:
    """axis, eigenvalue, pct_inertia, cum_pct, broken_stick_pct, chosen; none for fewer than 10 genes."""
    o = Ordination(run)
    cum = np.cumsum(o.percent[: o.axes]) if o.axes else ()
    rows = [(k + 1, float(o.values[k]), float(o.percent[k]), float(cum[k]), float(o.stick[k]), k < o.chosen()) for k in range(o.axes)]
    return run.spark.createDataFrame(rows, "axis int, eigenvalue double, pct_inertia double, cum_pct double, broken_stick_pct double, chosen boolean")


@needs("gene_codons")
def coa_genes(run: Run) -> DataFrame:
    o = Ordination(run)
    if not o.axes:
        return run.spark.createDataFrame([], "gene long, axis int, coordinate double")
    return o.coordinates(run, o.axes).select("gene", F.posexplode("zs").alias("k", "coordinate")).select("gene", (F.col("k") + 1).alias("axis"), "coordinate")


@needs("gene_codons", "codon_dim")
def coa_codons(run: Run) -> DataFrame:
    o = Ordination(run)
    codons = [r["codon"] for r in run("codon_dim").where("sense").orderBy("codon").collect()]  # 59 rows
    at = (o.vectors * np.sqrt(o.values[: o.axes]) * o.scale[:, None] * math.sqrt(o.grand)) if o.axes else np.zeros((0, 2))
    return run.spark.createDataFrame([(c, float(x[0]), float(x[1])) for c, x in zip(codons, at, strict=False)], "codon string, axis1 double, axis2 double")


# ---------------------------------------------------------------- the reference's cluster
def _robust(rows: DataFrame, axes: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Robust centre and covariance of (zs), or None for fewer than axes + 2 rows."""
    got = robust(rows.select(F.lit("").alias("grp"), "zs")).get("")
    return (got.centre, got.covariance) if got and got.n >= axes + 2 else None


@needs("gene_coordinates")
def reference_fit(run: Run) -> DataFrame:
    """centre, covariance: the robust fit of the reference genes on the chosen axes; no row for fewer than axes + 2 of them."""
    refs = run("gene_coordinates").where("is_ref")
    first = refs.select(F.size("zs")).first()
    got = _robust(refs, first[0]) if first else None
    return run.spark.createDataFrame([(got[0].tolist(), got[1].ravel().tolist())] if got else [], "centre array<double>, covariance array<double>")


def fit_of_reference(run: Run) -> tuple[np.ndarray, np.ndarray] | None:
    """Centre and covariance of ``reference_fit``, if there are any."""
    got = run("reference_fit").first()
    return got and (np.array(got["centre"]), np.reshape(got["covariance"], (len(got["centre"]), -1)))


def _distances(centre: np.ndarray, covariance: np.ndarray, keep: str):
    """Adds each row's Mahalanobis distance; ``keep`` names the columns that stay."""
    inverse, names = np.linalg.pinv(covariance, rcond=1e-10), [c.strip().split(" ")[0] for c in keep.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                d = np.stack(b.zs.to_numpy()) - centre
                yield b[names].assign(distance=np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", d, inverse, d), 0)))

    return run


MEMBER = "gene long, sample_id string, genome string, cond string, distance double, threshold double, membership double, weight double, in_cluster boolean, is_ref boolean, outlier boolean"


@needs("gene_coordinates", "reference_fit")
def membership(run: Run) -> DataFrame:
    """Each gene's distance to the reference genes on the chosen axes; threshold: the distance that covers 90 % of these.

    ``outlier``: beyond the 95 % bound of chi-square.  None without 10 genes or enough reference genes.
    """
    fitted = fit_of_reference(run)
    if fitted is None:
        return run.spark.createDataFrame([], MEMBER)
    keep = "gene long, sample_id string, genome string, cond string, is_ref boolean"
    far = run("gene_coordinates").mapInPandas(_distances(*fitted, keep), f"{keep}, distance double")
    cut = far.where("is_ref").agg(F.percentile("distance", F.lit(COVERED)).alias("threshold"))
    out = far.crossJoin(F.broadcast(cut))  # one row
    scale = F.greatest(F.col("threshold") / 5, F.lit(1e-6))
    z = F.greatest(F.least((F.col("distance") - F.col("threshold")) / scale, F.lit(500.0)), F.lit(-500.0))
    out = out.withColumn("membership", 1 / (1 + F.exp(z))).withColumn("weight", F.greatest(1 - F.col("distance") / F.col("threshold"), F.lit(0.0)))
    out = out.withColumn("in_cluster", F.col("distance") <= F.col("threshold")).withColumn("outlier", F.col("distance") > math.sqrt(chi_square_quantile(0.95, len(fitted[0]))))
    return out.select(*[c.strip().split(" ")[0] for c in MEMBER.split(",")])


@needs("membership")
def cluster_genes(run: Run) -> DataFrame:
    return run.sql("SELECT gene, round(distance, 6) AS distance, round(threshold, 6) AS threshold, round(membership, 6) AS membership, round(weight, 6) AS weight, in_cluster, is_ref FROM membership")


@needs("membership", "grid")
def cluster_rscu(run: Run) -> DataFrame:
    """Usage of the cluster, each gene weighted by its nearness."""
    return run.sql("""SELECT codon, round(n * ffold / nullif(sum(n) OVER (PARTITION BY family), 0), 6) AS rscu FROM (SELECT g.codon, g.family, g.ffold, sum(g.n * m.weight) AS n FROM grid g JOIN membership m ON m.gene = g.gene AND m.in_cluster GROUP BY g.codon, g.family, g.ffold) x""")


@needs("membership", "conds", "pair_of_conds", "burden_test", "burden_kw")
def burden(run: Run) -> DataFrame:
    return run.sql("SELECT test, item AS metric, g1, g2, round(statistic, 5) AS statistic, round(delta, 6) AS delta, round(p, 6) AS p FROM (SELECT 'mann_whitney' AS test, item, g1, g2, u AS statistic, delta, p FROM burden_test UNION ALL SELECT 'kruskal_wallis', item, '', '', h, CAST(NULL AS DOUBLE), p FROM burden_kw) x")


on_spark("sample_burden", "SELECT sample_id, cond, item, v FROM (SELECT sample_id, cond, round(percentile(distance, 0.5), 9) AS a, round(avg(CASE WHEN outlier THEN 1e0 ELSE 0e0 END), 9) AS b FROM membership GROUP BY sample_id, cond) x LATERAL VIEW explode(map('median_distance', a, 'outlier_share', b)) t AS item, v")
on_spark("burden_two", "SELECT s.item, p.g1, p.g2, CASE WHEN s.cond = p.g1 THEN 1 ELSE 0 END AS first_one, s.v FROM sample_burden s JOIN pair_of_conds p ON s.cond = p.g1 OR s.cond = p.g2")
on_spark("burden_by", "SELECT item, cond AS grp, v FROM sample_burden")
two_sample("burden_test", "burden_two", 3)
kruskal("burden_kw", "burden_by", 3)


# ---------------------------------------------------------------- foreign genes
def _shrunk(n: float, mean: np.ndarray, covariance: np.ndarray, fourth: float) -> tuple[int, float, np.ndarray]:
    """(dimensions, shrinkage, inverse) of the Ledoit-Wolf covariance; on the principal components where there are fewer genes than codons."""
    p = len(mean)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    k = p if n >= p else min(int(n) - 1, p)
    values, vectors = np.maximum(values[::-1][:k], 0), vectors[:, ::-1][:, :k]
    mu, square = values.mean(), float((values**2).sum())
    delta = (square - 2 * mu * values.sum() + k * mu * mu) / k
    beta = min((fourth / n - square) / (k * n), delta)
    s = 0.0 if beta <= 0 or delta <= 0 else beta / delta
    mixed = (1 - s) * values + s * mu
    inverse = np.where(mixed > 1e-15 * max(mixed.max(), 1e-300), 1 / np.maximum(mixed, 1e-300), 0)
    return k, s, (vectors * inverse) @ vectors.T


def foreign(run: Run, group: str, flag: float = FLAG, share: float = 0.05) -> DataFrame:
    """gene, grp, distance, shrinkage, p, q, flag_fdr, flag_adaptive, gc3_deviation, gc3_outlier, flag: genes that lie far from their group's mean over the independent codons.

    Genes that lack one of these codons' families, and groups of fewer than 10 others, are left out.
    """
    rows = run("gene_codons").where("whole").select("gene", F.expr(group).alias("grp"), F.col("ind").alias("xs"))
    first = moments(rows).where("m[0] >= 10")
    p = F.size("xs")
    centred = rows.join(first, "grp").select("gene", "grp", F.zip_with("xs", F.slice("m", 2, p), lambda x, s: x - s / F.col("m")[0]).alias("zs"))
    fourth = centred.select("grp", F.pow(F.aggregate("zs", F.lit(0.0), lambda a, z: a + z * z), F.lit(2)).alias("f")).groupBy("grp").agg(F.sum("f").alias("fourth"))

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for grp, m, f in zip(b.grp, b.m, b.fourth, strict=True):
                n, s, c = _apart(m)
                k, shrinkage, inverse = _shrunk(n, s / n, c / n - np.outer(s, s) / n / n, f)
                out.append((grp, k, shrinkage, inverse.ravel().tolist()))
            yield pd.DataFrame(out, columns=["grp", "k", "shrinkage", "inverse"])

    fits = first.join(fourth, "grp").mapInPandas(invert, "grp string, k int, shrinkage double, inverse array<double>")

    def distance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d2 = np.zeros(len(b))
            for _, at in b.groupby("grp").indices.items():
                z = np.stack(b.zs.iloc[at].to_numpy())
                d2[at] = np.einsum("ij,jk,ik->i", z, np.asarray(b.inverse.iloc[at[0]]).reshape(z.shape[1], -1), z)
            tail = [float(chi_square_upper(np.array([x]), int(k))[0]) for x, k in zip(d2, b.k, strict=True)]
            yield pd.DataFrame({"gene": b.gene, "grp": b.grp, "shrinkage": b.shrinkage, "distance": np.sqrt(np.maximum(d2, 0)), "p": tail})

    far = centred.join(fits, "grp").mapInPandas(distance, "gene long, grp string, shrinkage double, distance double, p double")
    gc = run("gc").select("gene", F.expr(group).alias("grp"), "gc3")
    spread = gc.groupBy("grp").agg(F.avg("gc3").alias("m"), F.stddev_pop("gc3").alias("s"), F.count("*").alias("c"))
    flagged = run.sql(_FLAGS.format(flag=flag), far=far, cut=far.groupBy("grp").agg(F.percentile("distance", F.lit(1 - share)).alias("cut")), gc3=gc, spread=spread)
    return flagged


_FLAGS = """SELECT x.gene, x.grp, x.distance, x.shrinkage, x.p, x.q, x.q < {flag} AS flag_fdr, x.distance > c.cut AS flag_adaptive, g.gc3 - s.m AS gc3_deviation, coalesce(s.c > 5 AND abs(g.gc3 - s.m) > 2 * s.s, false) AS gc3_outlier,
  x.q < {flag} OR coalesce(s.c > 5 AND abs(g.gc3 - s.m) > 2 * s.s, false) AS flag
  FROM (SELECT gene, grp, distance, shrinkage, p, least(1e0, min(p * m / r) OVER (PARTITION BY grp ORDER BY r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q
    FROM (SELECT gene, grp, distance, shrinkage, p, row_number() OVER (PARTITION BY grp ORDER BY p, gene) AS r, count(*) OVER (PARTITION BY grp) AS m FROM far) y) x
  JOIN cut c ON c.grp = x.grp LEFT JOIN gc3 g ON g.gene = x.gene LEFT JOIN spread s ON s.grp = x.grp"""


@needs("gene_codons", "gc")
def foreign_genes(run: Run) -> DataFrame:
    """All genes as one group, and each genome by itself."""
    both = foreign(run, "'all'").withColumn("scope", F.lit("all")).unionByName(foreign(run, "genome").withColumn("scope", F.lit("genome")))
    return both.select("scope", "gene", "grp", *[F.round(c, 6).alias(c) for c in ("distance", "shrinkage", "p", "q", "gc3_deviation")], "flag_fdr", "flag_adaptive", "gc3_outlier", "flag")


# ---------------------------------------------------------------- islands
def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian mean over four deviations, mirrored at the ends."""
    reach = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, reach, mode="symmetric"), w / w.sum(), "valid")


def peaks(x: np.ndarray, least: float = PROMINENCE) -> list[int]:
    """Places of local maxima that stand out by ``least``; the middle of a flat top."""
    out, i = [], 1
    while i < len(x) - 1:
        j = i
        while j < len(x) - 1 and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j < len(x) - 1 and x[j + 1] < x[i]:
            left, right = np.flatnonzero(x[:i] > x[i]), np.flatnonzero(x[j + 1 :] > x[i])
            a, b = (left[-1] + 1 if len(left) else 0), (j + 1 + right[0] if len(right) else len(x))
            if x[i] - max(x[a:i].min(), x[j + 1 : b].min()) >= least:
                out.append((i + j) // 2)
        i = j + 1
    return out


def regions(x: np.ndarray, least: float = PROMINENCE) -> list[tuple[int, int]]:
    """Runs of bins above the median around each peak, touching ones merged."""
    if len(x) < 3:
        return []
    base, out = float(np.median(x)), []
    for p in peaks(x, least):
        a = b = p
        while a > 0 and x[a - 1] > base:
            a -= 1
        while b < len(x) - 1 and x[b + 1] > base:
            b += 1
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


@needs("membership", "placed")
def islands(run: Run) -> DataFrame:
    """genome, island, first_bin, last_bin, start_bp, end_bp, n_genes, mean_divergence, peak_divergence: peaks of the binned distance from the reference along each genome.

    A genome's bins, one for each 30 genes, are searched together.
    """
    genes = run.sql("SELECT p.genome, p.gene, p.start_bp, p.start_bp + p.length - 1 AS end_bp, 1 - m.membership AS d, row_number() OVER (PARTITION BY p.genome ORDER BY p.start_bp, p.gene) - 1 AS k FROM placed p JOIN membership m ON m.gene = p.gene")
    bins = genes.withColumn("bin", F.floor(F.col("k") / BIN)).groupBy("genome", "bin").agg(F.count("*").alias("n"), F.avg("d").alias("d"), F.max("d").alias("peak"), F.min("start_bp").alias("start_bp"), F.max("end_bp").alias("end_bp")).where(F.col("n") == BIN)

    def find(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("bin")
        out = []
        for i, (lo, hi) in enumerate(regions(smoothed(b.d.to_numpy())), 1):
            part = b.iloc[lo : hi + 1]
            out.append((b.genome.iloc[0], f"GI_{i:02d}", int(part.bin.iloc[0]), int(part.bin.iloc[-1]), int(part.start_bp.min()), int(part.end_bp.max()), int(part.n.sum()), float(part.d.mean()), float(part.peak.max())))
        return pd.DataFrame(out, columns=["genome", "island", "first_bin", "last_bin", "start_bp", "end_bp", "n_genes", "mean_divergence", "peak_divergence"])

    return bins.groupBy("genome").applyInPandas(find, "genome string, island string, first_bin long, last_bin long, start_bp long, end_bp long, n_genes long, mean_divergence double, peak_divergence double")


# ---------------------------------------------------------------- clusters
def components(rows: DataFrame, most: int) -> tuple[DataFrame, np.ndarray]:
    """Rows (key, xs) with zs: their first principal components; and the variances."""
    got = moments(rows.select(F.lit("").alias("grp"), "xs")).collect()  # one row
    n, s, c = _apart(got[0]["m"])
    mean = s / n
    values, vectors = np.linalg.eigh(c / n - np.outer(mean, mean))
    k = min(most, len(mean), max(int(n) - 1, 1))
    v = _signed(vectors[:, ::-1][:, :k])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b[["key"]].assign(zs=((np.stack(b["xs"].to_numpy()) - mean) @ v).tolist())

    return rows.select("key", "xs").mapInPandas(project, "key string, zs array<double>"), np.maximum(values[::-1][:k], 0)


def clustered(rows: DataFrame, most: int, each: int, clusters: int, seed: int = 42) -> DataFrame:
    """key, cluster, axis1, axis2: k-means on principal components, k a cluster for every ``each`` rows, 2 to ``clusters``; none for fewer than 4 rows."""
    n = rows.count()
    if n < 4:
        return rows.sparkSession.createDataFrame([], "key string, cluster int, axis1 double, axis2 double")
    at, _ = components(rows, most)
    vectors = at.withColumn("features", array_to_vector("zs"))
    model = KMeans(k=int(np.clip(n // each, 2, clusters)), seed=seed, initMode="k-means||").fit(vectors)
    out = model.transform(vectors).withColumn("z", vector_to_array("features"))
    return out.select("key", F.col("prediction").alias("cluster"), F.round(F.col("z")[0], 6).alias("axis1"), F.round(F.coalesce(F.get("z", F.lit(1)), F.lit(0.0)), 6).alias("axis2"))


@needs("sample_codon", "sample_metric")
def sample_features(run: Run) -> DataFrame:
    """sample_id, feature, v: robust z of each sample's codon usage and metrics; 0 where a feature does not vary or is missing."""
    return run.sql("SELECT f.sample_id, f.feature, coalesce(CASE WHEN d.d < 1e-12 THEN 0e0 ELSE (f.v - m.m) / (1.4826e0 * d.d) END, 0e0) AS v FROM feature f JOIN feature_median m ON m.feature = f.feature JOIN feature_spread d ON d.feature = f.feature")


on_spark("feature", "SELECT sample_id, codon AS feature, v FROM sample_codon UNION ALL SELECT sample_id, metric AS feature, v FROM sample_metric")
on_spark("feature_median", "SELECT feature, percentile(v, 0.5) AS m FROM feature GROUP BY feature")
on_spark("feature_spread", "SELECT f.feature, percentile(abs(f.v - m.m), 0.5) AS d FROM feature f JOIN feature_median m ON m.feature = f.feature GROUP BY f.feature")


def _vectors(long: DataFrame, key: str) -> DataFrame:
    return long.groupBy(F.col(key).cast("string").alias("key")).agg(F.transform(F.array_sort(F.collect_list(F.struct("feature", "v"))), lambda e: e["v"]).alias("xs"))  # one entry a feature


@needs("sample_features")
def sample_clusters(run: Run) -> DataFrame:
    return clustered(_vectors(run("sample_features"), "sample_id"), 30, 5, 8).withColumnRenamed("key", "sample_id")


@needs("gene_clrs")
def gene_clusters(run: Run) -> DataFrame:
    rows = written(run("gene_clrs").select(F.col("gene").cast("string").alias("key"), "xs"), new_folder(run.spark, "clusters"))
    return clustered(rows, 20, 50, 10).withColumn("key", F.col("key").cast("long")).withColumnRenamed("key", "gene")


@needs("sample_codon")
def sample_components(run: Run) -> DataFrame:
    """Two principal components of the samples' standardised usage."""
    z = run.sql("SELECT sample_id, codon AS feature, coalesce((v - avg(v) OVER (PARTITION BY codon)) / nullif(stddev_pop(v) OVER (PARTITION BY codon), 0), 0e0) AS v FROM sample_codon")
    at, variance = components(_vectors(z, "sample_id"), 2)
    return at.select(F.col("key").alias("sample_id"), F.round(F.col("zs")[0], 6).alias("pc1"), F.round(F.col("zs")[1], 6).alias("pc2"))


on_spark("driver_two", "SELECT c.k || ' ' || f.feature AS item, CAST(c.k AS VARCHAR(20)) AS g1, 'rest' AS g2, CASE WHEN s.cluster = c.k THEN 1 ELSE 0 END AS first_one, round(f.v, 9) AS v FROM sample_features f JOIN sample_clusters s ON s.sample_id = f.sample_id CROSS JOIN (SELECT DISTINCT cluster AS k FROM sample_clusters) c")
two_sample("driver_test", "driver_two", 3)
adjusted("driver_q", "driver_test")
on_spark("in_clusters", "SELECT g1 AS cluster, split_part(item, ' ', 2) AS feature, CAST(n1 AS BIGINT) AS n_in, CAST(n2 AS BIGINT) AS n_rest, round(delta, 6) AS delta, round(p, 6) AS p, round(q, 6) AS q, true AS post_selection_biased FROM driver_q")

on_spark("cluster_profile", "SELECT s.cluster, f.feature, round(avg(f.v), 6) AS mean_z, count(*) AS n_samples FROM sample_features f JOIN sample_clusters s ON s.sample_id = f.sample_id GROUP BY s.cluster, f.feature")


# ---------------------------------------------------------------- clusters within the genes of interest
LEAST_GENES, LEAST_MEMBERS, MOST_CLUSTERS = 6, 3, 8


@needs("gene_clr", "set_clr", "goi")
def goi_offsets(run: Run) -> DataFrame:
    """gene, feature, v: log-ratio usage of the genes of interest less the genome's."""
    return run.sql("SELECT g.gene, g.codon AS feature, g.x - s.x AS v FROM gene_clr g JOIN goi i ON i.gene = g.gene JOIN set_clr s ON s.codon = g.codon AND s.gene_set = 'all'")


@needs("goi_offsets")
def goi_clusters(run: Run) -> DataFrame:
    """gene, cluster, silhouette: k-means of the genes of interest, k of 2 to 8 by the silhouette among those that leave three genes in each cluster; none for fewer than 6 genes."""
    rows = written(_vectors(run("goi_offsets"), "gene").select(F.col("key").cast("long").alias("gene"), array_to_vector("xs").alias("features")), new_folder(run.spark, "goi"))
    n, best = rows.count(), None
    if n < LEAST_GENES:
        return run.spark.createDataFrame([], "gene long, cluster int, silhouette double")
    for k in range(2, min(MOST_CLUSTERS, n // LEAST_MEMBERS) + 1):
        out = KMeans(k=k, seed=42).fit(rows).transform(rows)
        sizes = [r["count"] for r in out.groupBy("prediction").count().collect()]  # k rows
        if len(sizes) > 1 and (min(sizes) >= LEAST_MEMBERS or k == 2):
            score = ClusteringEvaluator().evaluate(out)
            if best is None or score > best[0]:
                best = (score, out)
    if best is None:
        return rows.select("gene", F.lit(0).alias("cluster"), F.lit(None).cast("double").alias("silhouette"))
    return best[1].select("gene", F.col("prediction").alias("cluster"), F.round(F.lit(float(best[0])), 6).alias("silhouette"))


on_spark("goi_features", "SELECT gene, feature, v FROM goi_offsets UNION ALL SELECT m.gene, m.metric AS feature, m.v FROM metric m JOIN goi i ON i.gene = m.gene")
on_spark("goi_two", "SELECT c.k || ' ' || f.feature AS item, CAST(c.k AS VARCHAR(20)) AS g1, 'rest' AS g2, CASE WHEN s.cluster = c.k THEN 1 ELSE 0 END AS first_one, round(f.v, 9) AS v FROM goi_features f JOIN goi_clusters s ON s.gene = f.gene CROSS JOIN (SELECT DISTINCT cluster AS k FROM goi_clusters) c")
two_sample("goi_driver", "goi_two", 3)
adjusted("goi_driver_q", "goi_driver")
on_spark("goi_drivers", "SELECT g1 AS cluster, split_part(item, ' ', 2) AS feature, CAST(n1 AS BIGINT) AS n_in, CAST(n2 AS BIGINT) AS n_rest, round(delta, 6) AS delta, round(p, 6) AS p, round(q, 6) AS q, true AS post_selection_biased FROM goi_driver_q")
for name, form in (("goi_offsets", goi_offsets), ("goi_clusters", goi_clusters)):
    on_spark(name, form)
KEPT.update({"goi_offsets", "goi_clusters"})
spark_query("mv23_goi_clusters", "SELECT gene, cluster, silhouette FROM goi_clusters")
spark_query("st31_goi_drivers", "SELECT cluster, feature, n_in, n_rest, delta, p, q, post_selection_biased FROM goi_drivers")


# ---------------------------------------------------------------- boundary and mixtures of the reference
@needs("membership", "refset")
def gap_boundary(run: Run) -> DataFrame:
    """n_ref, boundary, rule: where the reference's sorted distances part: the largest gap that begins between the 90 % and 99.9 % bounds of chi-square, or is three times the median gap below the 99.999 % bound."""
    axes = Ordination(run).chosen() if run("membership").limit(1).count() else 2
    lo, mid, hi, far, usual = (math.sqrt(chi_square_quantile(p, axes)) for p in (0.90, 0.99, 0.999, 0.99999, 0.95))
    refs = ordered(run.sql("SELECT gene, distance FROM membership WHERE is_ref"), F.col("distance"), F.col("gene"))
    return run.sql(
        f"""SELECT n_ref, CASE WHEN n_ref < 4 THEN {usual}e0 WHEN best IS NOT NULL THEN best ELSE least(greatest({mid}e0, lowest), highest) END AS boundary, CASE WHEN n_ref < 4 THEN 'few' WHEN best IS NOT NULL THEN 'gap' ELSE 'bound' END AS rule
  FROM (SELECT max(n) AS n_ref, min(d) AS lowest, max(d) AS highest, max_by(CASE WHEN fits THEN (d + nxt) / 2 END, CASE WHEN fits THEN nxt - d END) AS best FROM (SELECT a.n, a.distance AS d, b.distance AS nxt,
    (a.distance BETWEEN {lo}e0 AND {hi}e0) OR (a.distance <= {far}e0 AND a.distance >= {lo}e0 AND b.distance - a.distance >= 3 * m.med) AS fits FROM refs a LEFT JOIN refs b ON b.r = a.r + 1
    CROSS JOIN (SELECT percentile(y.distance - x.distance, 0.5) AS med FROM refs x JOIN refs y ON y.r = x.r + 1) m) g) z WHERE n_ref > 0""",
        refs=refs,
    )


@needs("gene_codons", "refset")
def reference_mixtures(run: Run) -> DataFrame:
    """k, bic, chosen: Gaussian mixtures of one to four parts of the reference genes on two axes; none for fewer than 15 of them."""
    o = Ordination(run)
    schema = "k int, log_likelihood double, bic double, chosen boolean"
    if not o.axes:
        return run.spark.createDataFrame([], schema)
    rows = o.coordinates(run, 2).join(run("refset"), "gene", "left_semi").select(array_to_vector("zs").alias("features"))
    rows = written(rows, new_folder(run.spark, "mixtures"))
    n = rows.count()
    if n < 15:
        return run.spark.createDataFrame([], schema)
    _, s, c = _apart(moments(rows.select(F.lit("").alias("grp"), vector_to_array("features").alias("xs"))).first()["m"])
    spread = max(float(np.linalg.det(c / n - np.outer(s, s) / n / n)), 1e-300)
    out = []
    for k in range(1, 5):
        fit = GaussianMixture(k=k, seed=1, maxIter=100).fit(rows).summary.logLikelihood if k > 1 else -n / 2 * (2 * math.log(2 * math.pi) + math.log(spread) + 2)
        out.append((k, float(fit), float(-2 * fit + (k * 6 - 1) * math.log(n))))
    best = min(out, key=lambda x: x[2])[0]
    return run.spark.createDataFrame([(*x, x[0] == best) for x in out], schema)


for name, form in (("gene_codons", gene_codons), ("codon_moments", codon_moments), ("reference_fit", reference_fit), ("membership", membership), ("gap_boundary", gap_boundary), ("sample_features", sample_features), ("sample_clusters", sample_clusters)):
    on_spark(name, form)
KEPT.update({"gene_codons", "codon_moments", "reference_fit", "membership", "sample_features", "sample_clusters"})
for name, form in (
    ("mv01_coa_inertia", coa_inertia), ("mv01_coa_genes", coa_genes), ("mv01_coa_codons", coa_codons), ("mv05_foreign_genes", foreign_genes), ("mv12_cluster_genes", cluster_genes), ("ag25_cluster_rscu", cluster_rscu),
    ("be06_divergence_islands", islands), ("mv20_sample_clusters", sample_clusters), ("mv21_gene_clusters", gene_clusters), ("mv24_sample_components", sample_components), ("st23_foreign_burden", burden),
    ("st30_cluster_drivers", "SELECT * FROM in_clusters"), ("fg18_cluster_profiles", "SELECT * FROM cluster_profile"), ("wn13_gap_boundary", "SELECT * FROM gap_boundary"), ("mv10_reference_mixtures", reference_mixtures),
):
    spark_query(name, form)
