"""How stable the reference's cluster is: full resamples, out-of-bag recovery, bagged estimates, sub-clusters and rescue.

A resample draws reference genes by a hash of its number and the gene, so draws need no
state and a lost task draws the same again.  Each resample is fitted in one task: its dense
core, the robust fit of that core and the gap in its own distances.  The fits, a few
numbers each, then judge all genes where these are.

A resample has as many draws as the reference has genes.  Where these are more than a task
holds (``TASK_REFS``), resamples are fitted by passes of Spark over all of their rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from synonymy.functions.digests import md5_words
from synonymy.llm.common import column
from synonymy.operators.density import CORE_LEAST, GRID, densities, smoothed
from synonymy.operators.moments import apart, chi_square_quantile, moments
from synonymy.operators.multivariate import Ordination, _distances
from synonymy.operators.robust import Fit, robust, squared, two_passes
from synonymy.plans.relations import KEPT, Run, needs, on_spark, spark_query
from synonymy.sources.shared import new_folder, written

REPLICATES, BAGGED, SPLITS, RESAMPLE = 100, 200, 100, 50_000
#: Reference genes of which a task holds a resample; beyond, it is fitted by passes.
TASK_REFS = 1_000_000
#: Rows that are held against all fits at once.
JUDGED = 1000
#: In how many resamples a core gene is a member; weights of overlap, core frequency and cosine in the composite score.
CORE, WEIGHTS = 0.5, (0.4, 0.3, 0.3)
#: Mean overlap from which a sub-cluster counts as stable, and below which it is dissolved.
STABLE, DISSOLVED = 0.75, 0.60
#: Rescue: margin below the least cosine of the core, and how many boundaries away.
MARGIN, REACH = 0.005, 2.0
#: Sub-clusters: genes to look for any, most parts, least share of a part, genes for each axis.
LEAST_GENES, MOST_PARTS, LEAST_SHARE, EACH_AXIS = 15, 4, 0.12, 8
STEPS, STARTS, RIDGE = 100, 3, 1e-4


# ---------------------------------------------------------------- resamples
def _steps(mean: float) -> list[float]:
    """Cumulated probabilities of a Poisson count."""
    out, p = [], math.exp(-mean)
    for k in range(9):
        out.append(p + (out[-1] if out else 0.0))
        p *= mean / (k + 1)
    return out


def draws(replicate: int, genes: np.ndarray, mean: float) -> np.ndarray:
    """How often a resample draws each of these genes: by the first 13 digits of md5(replicate-gene)."""
    u = ((md5_words(f"{replicate}-", genes)[0] >> np.uint64(12)).astype(float) + 0.5) / float(16**13)
    return np.searchsorted(_steps(mean), u).astype(np.int32)


def drawn(rows: DataFrame, replicates: int, *columns: str, mean: float = 1.0) -> DataFrame:
    """grp, times and the columns of the rows (gene, ...) that each resample draws; ``mean`` 1: as many draws as there are rows."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            genes = column(b, "gene").to_numpy(zero_copy_only=False)
            for i in range(replicates):
                times = draws(i, genes, mean)
                at = np.flatnonzero(times)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.repeat(str(i), len(at)), pa.array(times[at]), *[column(b, c).take(pa.array(at)) for c in columns]], names=["grp", "times", *columns])

    kinds = dict(rows.dtypes)
    return rows.select(*dict.fromkeys(["gene", *columns])).mapInArrow(draw, ", ".join(["grp string", "times int", *[f"{c} {kinds[c]}" for c in columns]]))


def resampled(rows: DataFrame, replicates: int, n: int, *columns: str) -> DataFrame:
    """``drawn``, but of more than ``RESAMPLE`` rows that many draws: the sub-clusters' mixtures alone are resampled so."""
    return drawn(rows, replicates, *columns, mean=min(1.0, RESAMPLE / max(n, 1)))


def gap(distances: np.ndarray, axes: int) -> float:
    """Where sorted distances part: the rule of ``gap_boundary``."""
    lo, mid, hi, far, usual = (math.sqrt(chi_square_quantile(p, axes)) for p in (0.90, 0.99, 0.999, 0.99999, 0.95))
    d = np.sort(distances)
    if len(d) < 4:
        return usual
    width = np.diff(d)
    fits = ((d[:-1] >= lo) & (d[:-1] <= hi)) | ((d[:-1] >= lo) & (d[:-1] <= far) & (width >= 3 * np.median(width)))
    if not fits.any():
        return float(min(max(mid, d[0]), d[-1]))
    k = int(np.where(fits, width, -1.0).argmax())
    return float((d[k] + d[k + 1]) / 2)


def core_fit(x: np.ndarray, weights: np.ndarray) -> tuple[Fit, float]:
    """The robust fit of a resample's dense core, and the boundary in the distances of all it drew."""
    axes, core = x.shape[1], x
    if len(x) >= CORE_LEAST and np.linalg.matrix_rank(np.cov(x[:, :2].T)) == 2:
        at = densities(x)
        core = x[at >= np.median(at)]
    if len(core) < max(3, axes + 1):
        core = np.repeat(x, weights, axis=0)
    fit = two_passes(core)
    return fit, gap(np.sqrt(squared(x, fit.centre[None], fit.covariance[None])[0]), axes)


FITS = "grp string, centre array<double>, covariance array<double>, boundary double"


def _fit_replicate(b: pd.DataFrame) -> pd.DataFrame:
    b = b.sort_values("gene")
    fit, boundary = core_fit(np.stack(b.zs.to_numpy()), b.times.to_numpy())
    return pd.DataFrame({"grp": b.grp.iloc[:1].to_numpy(), "centre": [fit.centre.tolist()], "covariance": [fit.covariance.ravel().tolist()], "boundary": boundary})


@needs("gene_codons", "refset")
def coordinates(run: Run) -> DataFrame:
    """gene, sample_id, genome, cond, zs, is_ref: all genes on the chosen axes; none without 10 genes."""
    o = Ordination(run)
    if not o.axes:
        return run.spark.createDataFrame([], "gene long, sample_id string, genome string, cond string, zs array<double>, is_ref boolean")
    rows = o.coordinates(run, o.chosen())
    return rows.join(run("refset").withColumn("is_ref", F.lit(True)), "gene", "left").withColumn("is_ref", F.coalesce("is_ref", F.lit(False)))


def judged(batches: Iterator[pd.DataFrame], centres: np.ndarray, covariances: np.ndarray, bounds: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows (gene, is_ref, zs, out) under each fit, ``JUDGED`` at a time: one of them costs some kilobytes for each hundred fits."""
    for whole in batches:
        for at in range(0, len(whole), JUDGED):
            b = whole.iloc[at : at + JUDGED]
            inside = (np.sqrt(squared(np.stack(b.zs.to_numpy()), centres, covariances)) <= bounds).T.astype(float)
            tested = np.stack(b.out.to_numpy()).astype(float)
            yield pd.DataFrame({"gene": b.gene.to_numpy(), "is_ref": b.is_ref.to_numpy(), "inside": list(inside), "tested": list(tested), "recovered": list(inside * tested)})


def fits_by_passes(rows: DataFrame) -> list[dict]:
    """``FITS`` of resamples (grp, zs) that no task holds: the steps of ``core_fit`` over all of their rows."""
    rows = written(rows.select("grp", "zs"), new_folder(rows.sparkSession, "resamples"))
    axes = rows.select(F.size("zs")).first()[0]
    core = rows
    if axes > 1:
        plane = [F.col("zs")[k] for k in (0, 1)]
        pad = [F.greatest((F.max(x) - F.min(x)) * 0.05, F.lit(1e-9)) for x in plane]
        lines = [((F.min(x) - p).alias(f"low{k}"), ((F.max(x) - F.min(x) + 2 * p) / (GRID - 1)).alias(f"step{k}")) for k, (x, p) in enumerate(zip(plane, pad, strict=True))]
        shape = [F.covar_samp(plane[i], plane[j]).alias(f"v{i}{j}") for i, j in ((0, 0), (0, 1), (1, 1))]
        grids = rows.groupBy("grp").agg(*[c for pair in lines for c in pair], *shape)  # a row for each resample
        at = [F.greatest(F.least(F.rint((x - F.col(f"low{k}")) / F.col(f"step{k}")), F.lit(GRID - 1)), F.lit(0)).cast("int").alias(f"c{k}") for k, x in enumerate(plane)]
        placed = rows.join(F.broadcast(grids), "grp").select("grp", "zs", *at)
        cells = placed.groupBy("grp", "c0", "c1").agg(F.count("*").alias("n")).join(F.broadcast(grids), "grp")

        def dense(b: pd.DataFrame) -> pd.DataFrame:
            """The cells at or above the median density of their resample's rows: GRID * GRID at most."""
            n, i, j = b.n.to_numpy(), b.c0.to_numpy(), b.c1.to_numpy()
            covariance = np.array([[b.v00.iloc[0], b.v01.iloc[0]], [b.v01.iloc[0], b.v11.iloc[0]]])
            if np.linalg.matrix_rank(covariance) == 2:
                counts = np.zeros((GRID, GRID))
                counts[i, j] = n
                values = smoothed(counts, covariance * n.sum() ** (-1 / 3), b[["step0", "step1"]].iloc[0].to_numpy(float), float(n.sum()))[i, j]
                order = np.argsort(values)
                ends = np.cumsum(n[order])
                middle = values[order][np.searchsorted(ends, [(ends[-1] - 1) // 2, ends[-1] // 2], "right")].mean()
                b = b[values >= middle]
            return b[["grp", "c0", "c1"]]

        core = placed.join(cells.groupBy("grp").applyInPandas(dense, "grp string, c0 int, c1 int"), ["grp", "c0", "c1"], "left_semi").select("grp", "zs")
    fits = robust(core)

    def distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for grp, part in b.groupby("grp"):
                yield pd.DataFrame({"grp": grp, "d": np.sqrt(squared(np.stack(part.zs.to_numpy()), fits[grp].centre[None], fits[grp].covariance[None])[0])})

    # The rule of ``gap``; a resample's distances are sorted in a task, which may spill.
    lo, mid, hi, far = (math.sqrt(chi_square_quantile(p, axes)) for p in (0.90, 0.99, 0.999, 0.99999))
    widths = written(rows.mapInPandas(distances, "grp string, d double").withColumn("after", F.lead("d").over(Window.partitionBy("grp").orderBy("d"))), new_folder(rows.sparkSession, "gaps")).withColumn("width", F.col("after") - F.col("d"))
    ends = widths.groupBy("grp").agg(F.percentile("width", F.lit(0.5)).alias("usual"), F.min("d").alias("least"), F.max("d").alias("most"))
    parts = (F.col("d") >= lo) & ((F.col("d") <= hi) | (F.col("d") <= far) & (F.col("width") >= 3 * F.col("usual")))
    widest = F.max_by((F.col("d") + F.col("after")) / 2, F.when(parts & F.col("width").isNotNull(), F.struct("width", -F.col("d"))))
    bounds = widths.join(F.broadcast(ends), "grp").groupBy("grp").agg(F.coalesce(widest, F.least(F.greatest(F.lit(mid), F.first("least")), F.first("most"))).alias("boundary"))
    return [{"grp": r["grp"], "centre": fits[r["grp"]].centre.tolist(), "covariance": fits[r["grp"]].covariance.ravel().tolist(), "boundary": r["boundary"]} for r in bounds.collect()]  # a row for each resample


@needs("gene_coordinates")
def replicates(run: Run) -> DataFrame:
    """gene, is_ref, inside, tested, recovered: in which resamples a gene is a member, and for reference genes which left it out, and found it again."""
    schema = "gene long, is_ref boolean, inside array<double>, tested array<double>, recovered array<double>"
    rows = run("gene_coordinates").select("gene", "zs", "is_ref")
    refs = rows.where("is_ref").select("gene", "zs")
    n = refs.count()
    if n < 4:
        return run.spark.createDataFrame([], schema)
    every = drawn(refs, REPLICATES, "gene", "zs")
    if n <= TASK_REFS:
        every = every.repartition(REPLICATES, "grp")  # a resample or two a task, however many a shuffle's target size would put together
        got = every.groupBy("grp").applyInPandas(_fit_replicate, FITS).collect()  # a row for each resample
    else:
        got = fits_by_passes(every)
    fits = sorted(got, key=lambda r: int(r["grp"]))
    numbers = [int(r["grp"]) for r in fits]
    centres = np.array([r["centre"] for r in fits])
    covariances = np.array([r["covariance"] for r in fits]).reshape(len(fits), centres.shape[1], -1)
    bounds = np.array([r["boundary"] for r in fits])[:, None]

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, ref = np.zeros((len(b), len(numbers)), bool), b.is_ref.to_numpy()
            genes = b.gene.to_numpy()[ref].astype(np.int64)
            for k, i in enumerate(numbers):
                out[ref, k] = draws(i, genes, 1.0) == 0
            yield b.assign(out=list(out))

    return rows.mapInPandas(lambda batches: judged(left_out(batches), centres, covariances, bounds), schema)


def _sums(rows: DataFrame, *columns: str) -> list[np.ndarray]:
    got = rows.select(*[F.posexplode(F.arrays_zip(*columns)).alias("k", "x")]).groupBy("k").agg(*[F.sum(F.col("x")[c]).alias(c) for c in columns]).orderBy("k").collect()  # a row for each resample
    return [np.array([r[c] for r in got]) for c in columns]


@needs("membership_replicates", "rscu", "refset", "membership", "gap_boundary")
def stability(run: Run) -> DataFrame:
    """gene, frequency, stability, core, rescued, is_ref: core genes are members of at least half of the resamples; rescued ones are reference genes outside whose usage is as like the reference's as the core's least, within twice the boundary."""
    share = F.aggregate("inside", F.lit(0.0), lambda a, x: a + x) / F.size("inside")
    rows = run("membership_replicates").select("gene", "is_ref", F.round(share, 6).alias("frequency"))
    low, high = min(0.1, CORE * 0.2), min(CORE + (1 - CORE) / 2, 0.99)
    label = F.when(F.col("frequency") <= low, "absent").when(F.col("frequency") <= CORE, "unstable").when(F.col("frequency") <= high, "moderate").otherwise("stable")
    judged = rows.withColumn("stability", label).withColumn("core", F.col("frequency") >= CORE)
    return run.sql(
        f"""SELECT j.gene, j.frequency, j.stability, j.core, NOT j.core AND j.is_ref AND coalesce(c.cosine >= b.bar AND m.distance <= {REACH}e0 * g.boundary, false) AS rescued, j.is_ref
  FROM judged j LEFT JOIN ref_cosine c ON c.gene = j.gene LEFT JOIN (SELECT gene, distance FROM membership WHERE is_ref) m ON m.gene = j.gene
  CROSS JOIN (SELECT min(c.cosine) - {MARGIN}e0 AS bar FROM judged j JOIN ref_cosine c ON c.gene = j.gene WHERE j.core) b CROSS JOIN (SELECT max(boundary) AS boundary FROM gap_boundary) g""",
        judged=judged,
    )


on_spark("ref_usage", "SELECT r.gene, r.codon, coalesce(r.rscu, 0e0) AS x, r.rscu FROM rscu r JOIN refset f ON f.gene = r.gene")
on_spark("ref_consensus", "SELECT codon, coalesce(avg(rscu), 0e0) AS c FROM ref_usage GROUP BY codon")
on_spark("ref_cosine", "SELECT u.gene, round(sum(u.x * k.c) / nullif(sqrt(sum(u.x * u.x) * sum(k.c * k.c)), 0), 9) AS cosine FROM ref_usage u JOIN ref_consensus k ON k.codon = u.codon GROUP BY u.gene")
on_spark("core_usage", "SELECT codon, coalesce(n * ffold / nullif(sum(n) OVER (PARTITION BY family), 0), 0e0) AS x FROM (SELECT g.codon, g.family, g.ffold, CAST(sum(g.n) AS DOUBLE) AS n FROM grid g JOIN membership_stability s ON s.gene = g.gene AND (s.core OR s.rescued) GROUP BY g.codon, g.family, g.ffold) y")
on_spark("core_cosine", "SELECT sum(u.x * k.c) / nullif(sqrt(sum(u.x * u.x) * sum(k.c * k.c)), 0) AS cosine FROM core_usage u JOIN ref_consensus k ON k.codon = u.codon")


@needs("membership_replicates", "membership_stability", "core_cosine")
def metrics(run: Run) -> DataFrame:
    """One row: replicates, mean overlap of all pairs of them, mean frequency of core genes, mean share of left-out reference genes found again, sizes, the reference's share in the core, its cosine with the core, and the composite score."""
    schema = "n_replicates int, mean_jaccard double, mean_core_freq double, mean_oob_recovery double, n_core_genes long, n_rescued long, mean_cluster_size double, std_cluster_size double, cluster_frac double, ref_coverage double, cosine_sim double, composite_score double"
    inside = run("membership_replicates")
    got = moments(inside.select(F.lit("").alias("grp"), F.col("inside").alias("xs"))).collect()  # one row: sizes and overlaps
    if not got:
        return run.spark.createDataFrame([], schema)
    n, size, both = apart(got[0]["m"])
    union, pairs = size[:, None] + size[None, :] - both, np.triu_indices(len(size), 1)
    overlap = float(np.mean(np.where(union > 0, both / np.maximum(union, 1), 1.0)[pairs])) if len(pairs[0]) else 1.0
    tested, found = _sums(inside.where("is_ref"), "tested", "recovered")
    recovery = float(np.mean(found[tested > 0] / tested[tested > 0])) if (tested > 0).any() else None
    table = run("membership_stability")
    s = table.agg(F.avg(F.when(F.col("core") | F.col("rescued"), F.col("frequency"))).alias("f"), F.count_if(F.col("core") | F.col("rescued")).alias("core"), F.count_if("rescued").alias("rescued"), F.avg(F.when(F.col("is_ref"), F.col("core").cast("double"))).alias("covered")).first()
    cosine = run("core_cosine").first()["cosine"] if s["core"] >= 5 else None
    score = sum(w * x for w, x in zip(WEIGHTS, (overlap, s["f"] or 0.0, 0.5 if cosine is None else cosine), strict=True))
    rounded = lambda x, k=6: None if x is None else round(float(x), k)
    row = (len(size), rounded(overlap), rounded(s["f"] or 0.0), rounded(recovery), s["core"], s["rescued"], rounded(size.mean()), rounded(size.std()), rounded(size.mean() / n), rounded(s["covered"]), rounded(cosine), rounded(score))
    return run.spark.createDataFrame([row], schema)


# ---------------------------------------------------------------- the robust and the bagged estimate
@needs("gene_coordinates")
def robust_reference(run: Run) -> DataFrame:
    """axis, centre, variance, n_ref, n_outliers of the robust fit of the reference."""
    got = robust(run("gene_coordinates").where("is_ref").select(F.lit("").alias("grp"), "zs")).get("")
    rows = [(k + 1, float(c), float(v), got.n, got.outliers) for k, (c, v) in enumerate(zip(got.centre, np.diag(got.covariance), strict=True))] if got else []
    return run.spark.createDataFrame(rows, "axis int, centre double, variance double, n_ref int, n_outliers int")


def bagged(refs: DataFrame, n: int, count: int = BAGGED) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(mean centre, mean covariance, all centres) of robust fits of resamples of (gene, zs)."""
    every = drawn(refs, count, "zs").select("grp", "zs", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    # About n rows each, as often more as fewer: up to twice TASK_REFS are fitted in a task.
    fits = [f for _, f in sorted(robust(every, task_rows=2 * TASK_REFS).items(), key=lambda x: int(x[0]))]
    if not fits:
        return None
    centres = np.stack([f.centre for f in fits])
    return centres.mean(axis=0), np.mean([f.covariance for f in fits], axis=0), centres


@needs("gene_coordinates")
def bagged_reference(run: Run) -> DataFrame:
    """axis, centre, spread, variance, covariance_trace, n_replicates: means of the robust fits of 200 resamples; none for fewer than 3 reference genes."""
    refs = run("gene_coordinates").where("is_ref").select("gene", "zs")
    n = refs.count()
    got = bagged(refs, n) if n >= 3 else None
    rows = [(k + 1, float(got[0][k]), float(got[2][:, k].std()), float(got[1][k, k]), float(np.trace(got[1])), len(got[2])) for k in range(len(got[0]))] if got else []
    return run.spark.createDataFrame(rows, "axis int, centre double, spread double, variance double, covariance_trace double, n_replicates int")


# ---------------------------------------------------------------- sub-clusters
def _log_densities(x: np.ndarray, parts: list[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Logarithm of weight times density of each part at each row, as (rows, parts)."""
    out = []
    for w, centre, covariance in parts:
        d = np.linalg.solve(np.linalg.cholesky(covariance), (x - centre).T)
        out.append(math.log(max(w, 1e-300)) - 0.5 * ((d * d).sum(axis=0) + x.shape[1] * math.log(2 * math.pi) + np.linalg.slogdet(covariance)[1]))
    return np.stack(out, axis=1)


def mixture(x: np.ndarray, k: int) -> tuple[float, list[tuple[float, np.ndarray, np.ndarray]]]:
    """(log-likelihood, parts) of the best of a few runs of expectation-maximisation."""
    rng, best = np.random.default_rng(42), (-math.inf, [])
    n, p = x.shape
    for _ in range(STARTS if k > 1 else 1):
        seeds = [x[rng.integers(n)]]
        for _ in range(k - 1):  # far from those chosen
            far = np.min([((x - s) ** 2).sum(axis=1) for s in seeds], axis=0)
            seeds.append(x[rng.choice(n, p=far / far.sum())] if far.sum() > 0 else x[rng.integers(n)])
        share = np.eye(k)[np.argmin([((x - s) ** 2).sum(axis=1) for s in seeds], axis=0)]
        before = -math.inf
        for _ in range(STEPS):
            weight = share.sum(axis=0) + 1e-12
            centres = (share.T @ x) / weight[:, None]
            parts = []
            for j in range(k):
                d = x - centres[j]
                parts.append((weight[j] / n, centres[j], (d * share[:, j : j + 1]).T @ d / weight[j] + RIDGE * np.eye(p)))
            logs = _log_densities(x, parts)
            top = logs.max(axis=1, keepdims=True)
            total = top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))
            share = np.exp(logs - total[:, None])
            if total.sum() - before < 1e-3 * n * 1e-3:
                break
            before = total.sum()
        if total.sum() > best[0]:
            best = (float(total.sum()), parts)
    return best


def subclusters(x: np.ndarray) -> tuple[int, list[tuple[float, np.ndarray, np.ndarray]]]:
    """(axes used, parts) of the mixture of least BIC; one part where there are too few rows."""
    n, p = x.shape
    axes = min(p, max(2, n // EACH_AXIS))
    x = x[:, :axes]
    if n < LEAST_GENES:
        return axes, mixture(x, 1)[1]
    fits = [(k, *mixture(x, k)) for k in range(1, min(MOST_PARTS + 1, n))]
    bic = [-2 * logs + (k * (1 + axes + axes * (axes + 1) / 2) - 1) * math.log(n) for k, logs, _ in fits]
    return axes, fits[int(np.argmin(bic))][2]


def labels(x: np.ndarray, axes: int, parts: list) -> np.ndarray:
    return _log_densities(x[:, :axes], parts).argmax(axis=1)


def qualified(label: np.ndarray) -> list[int]:
    """Parts with at least 12 % of the rows, and three; all rows as one (-1) if none has."""
    size = np.bincount(label)
    return [int(k) for k in np.flatnonzero(size >= max(3, int(LEAST_SHARE * len(label))))] or [-1]


def matched(x: np.ndarray, label: np.ndarray, of: list[int]) -> list[float]:
    """For each part of a labelling the greatest overlap with a part that is found anew in these rows."""
    new = labels(x, *subclusters(x))
    sets = [np.ones(len(x), bool) if k < 0 else new == k for k in qualified(new)]
    out = []
    for k in of:
        own = np.ones(len(x), bool) if k < 0 else label == k
        out.append(max((float((own & s).sum() / max((own | s).sum(), 1)) for s in sets), default=0.0))
    return out


@needs("gene_coordinates", "ref_usage", "ref_consensus")
def subcluster_stability(run: Run) -> DataFrame:
    """cluster, n, mean_jaccard, jaccard_sd, stability, cosine, is_anchor: parts of the reference, how well 100 resamples find each again, and the one of them whose usage is most like the whole reference's.

    Parts are fitted on at most ``RESAMPLE`` genes and all reference genes are dealt to them.
    """
    schema = "cluster int, n long, mean_jaccard double, jaccard_sd double, stability string, cosine double, is_anchor boolean"
    refs = written(run("gene_coordinates").where("is_ref").select("gene", "zs"), new_folder(run.spark, "parts"))
    n = refs.count()
    if n < 4:
        return run.spark.createDataFrame([], schema)

    def fit(b: pd.DataFrame) -> pd.DataFrame:
        axes, parts = subclusters(np.stack(b.sort_values("gene").zs.to_numpy()))
        return pd.DataFrame({"axes": axes, "w": [w for w, _, _ in parts], "c": [c.tolist() for _, c, _ in parts], "v": [v.ravel().tolist() for _, _, v in parts]})

    some = refs.where(F.pmod(F.xxhash64("gene"), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, RESAMPLE / n))))
    got = some.withColumn("grp", F.lit("")).groupBy("grp").applyInPandas(fit, "axes int, w double, c array<double>, v array<double>").collect()  # a row for each part
    axes = got[0]["axes"]
    parts = [(r["w"], np.array(r["c"]), np.reshape(r["v"], (axes, axes))) for r in got]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(cluster=labels(np.stack(b.zs.to_numpy()), axes, parts))

    dealt = written(refs.mapInPandas(deal, "gene long, zs array<double>, cluster int"), new_folder(run.spark, "parts"))
    sizes = {r["cluster"]: r["count"] for r in dealt.groupBy("cluster").count().collect()}  # a row for each part
    of = sorted(k for k, size in sizes.items() if size >= max(3, int(LEAST_SHARE * n))) or [-1]
    if of == [-1]:
        dealt, sizes = dealt.withColumn("cluster", F.lit(-1)), {-1: n}

    def find(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("gene")
        return pd.DataFrame({"cluster": of, "jaccard": matched(np.stack(b.zs.to_numpy()), b.cluster.to_numpy(), of)})

    if len(of) == 1 and len(parts) == 1:
        spread = run.spark.createDataFrame([(of[0], 1.0, 0.0)], "cluster int, mean_jaccard double, jaccard_sd double")
    else:
        found = resampled(dealt, SPLITS, n, "gene", "zs", "cluster").groupBy("grp").applyInPandas(find, "cluster int, jaccard double")
        spread = found.groupBy("cluster").agg(F.round(F.avg("jaccard"), 6).alias("mean_jaccard"), F.round(F.stddev_pop("jaccard"), 6).alias("jaccard_sd"))
    table = run.spark.createDataFrame([(k, sizes[k]) for k in of], "cluster int, n long")
    usage = "SELECT d.cluster, u.codon, avg(u.x) AS x FROM ref_usage u JOIN dealt d ON d.gene = u.gene GROUP BY d.cluster, u.codon"
    return run.sql(
        f"""SELECT cluster, n, mean_jaccard, jaccard_sd, stability, round(cosine, 6) AS cosine, row_number() OVER (ORDER BY CASE WHEN stability <> 'dissolved' THEN 0 ELSE 1 END, CASE WHEN stability <> 'dissolved' THEN cosine ELSE mean_jaccard END DESC NULLS LAST, n DESC, cluster) = 1 AS is_anchor
  FROM (SELECT t.cluster, t.n, s.mean_jaccard, s.jaccard_sd, CASE WHEN s.mean_jaccard >= {STABLE} THEN 'stable' WHEN s.mean_jaccard < {DISSOLVED} THEN 'dissolved' ELSE 'uncertain' END AS stability, c.cosine
    FROM parts t JOIN spread s ON s.cluster = t.cluster LEFT JOIN (SELECT v.cluster, sum(v.x * k.c) / nullif(sqrt(sum(v.x * v.x) * sum(k.c * k.c)), 0) AS cosine FROM ({usage}) v JOIN ref_consensus k ON k.codon = v.codon GROUP BY v.cluster) c ON c.cluster = t.cluster) x""",
        parts=table, spread=spread, dealt=dealt,
    )


for name, form in (("gene_coordinates", coordinates), ("membership_replicates", replicates), ("membership_stability", stability)):
    on_spark(name, form)
KEPT.update({"gene_coordinates", "membership_replicates", "membership_stability"})
for name, form in (
    ("mv15_membership_stability", "SELECT gene, frequency, stability, core, rescued, is_ref FROM membership_stability"), ("mv15_stability_metrics", metrics), ("mv08_robust_reference", robust_reference),
    ("rs13_bagged_reference", bagged_reference), ("rs14_subcluster_stability", subcluster_stability),
):
    spark_query(name, form)
