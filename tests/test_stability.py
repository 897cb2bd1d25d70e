"""Resamples, recovery, rescue and sub-clusters against plain Python on planted data."""

import hashlib
import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from synonymy.operators import density, moments, robust, stability
from synonymy.plans import registry, relations  # noqa: F401  the registry defines all relations

SF = "/root/testdata/sf0.01"


def drawn(replicate, gene, mean=1.0):
    u = (int(hashlib.md5(f"{replicate}-{gene}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
    total, k, p = 0.0, 0, math.exp(-mean)
    while u > total + p and k < 9:
        total += p
        k += 1
        p *= mean / k
    return k


def patched(monkeypatch, spark, name, rows, schema):
    monkeypatch.setitem(relations.SPARK, name, relations.needs()(lambda run: spark.createDataFrame(rows, schema)))
    monkeypatch.setattr(relations, "KEPT", relations.KEPT - {name, "membership_replicates", "membership_stability"})


def cloud(seed=3, n=120, refs=60):
    """Reference genes in a tight cloud, five of them far off, other genes around and away."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    x[refs:] += [6, 0]
    x[refs - 5 : refs] += [0, 25]
    return [(g, r.tolist(), g < refs) for g, r in enumerate(x)]


def test_resamples_are_poisson_draws(spark):
    rows = spark.createDataFrame([(g,) for g in range(400)], "gene long")
    got = {(r.grp, r.gene): r.times for r in stability.resampled(rows, 5, 400, "gene").collect()}
    assert got == {(str(i), g): drawn(i, g) for i in range(5) for g in range(400) if drawn(i, g)}
    assert 0.9 < sum(got.values()) / 2000 < 1.1
    few = stability.resampled(rows, 5, 10 * stability.RESAMPLE, "gene").agg(F.sum("times")).first()[0]
    assert 120 < few < 280


def test_replicates_recover_left_out_genes(spark, monkeypatch):
    rows = cloud()
    patched(monkeypatch, spark, "gene_coordinates", rows, "gene long, zs array<double>, is_ref boolean")
    got = {r.gene: r for r in stability.replicates(relations.Run(spark, SF)).collect()}
    at = {g: np.array(z) for g, z, _ in rows}
    refs = [g for g, _, ref in rows if ref]
    for i in (0, 7, 42):
        bag = [g for g in refs if drawn(i, g)]
        x = np.stack([at[g] for g in bag])
        dense = density.densities(x)
        fit = robust.two_passes(x[dense >= np.median(dense)])
        far = lambda z: math.sqrt((z - fit.centre) @ np.linalg.inv(fit.covariance) @ (z - fit.centre))  # noqa: E731, B023
        bound = stability.gap(np.array([far(z) for z in x]), 2)
        for g in at:
            inside = far(at[g]) <= bound
            assert got[g].inside[i] == inside
            assert got[g].tested[i] == (g in refs and g not in bag) and got[g].recovered[i] == (g in refs and g not in bag and inside)
    assert np.mean([np.mean(got[g].inside) for g in refs[:-5]]) > 0.7 and max(np.mean(got[g].inside) for g in refs[-5:]) < 0.2


def test_gap_rule():
    lo, mid, far = (math.sqrt(moments.chi_square_quantile(p, 2)) for p in (0.90, 0.99, 0.99999))
    body = np.linspace(0.1, lo - 0.2, 50)
    assert stability.gap(np.append(body, [lo + 0.1, lo + 3.1]), 2) == pytest.approx(lo + 1.6)
    assert stability.gap(body, 2) == pytest.approx(body[-1]) and stability.gap(np.array([1.0, 2.0]), 2) == pytest.approx(math.sqrt(moments.chi_square_quantile(0.95, 2)))
    assert stability.gap(np.append(body, [far + 5, far + 9]), 2) == pytest.approx(mid)


def test_rescue_takes_reference_genes_of_like_usage(spark, monkeypatch):
    replicates = [(g, g < 8, [1.0] * 10 if g < 6 else [0.0] * 10, [0.0] * 10, [0.0] * 10) for g in range(12)]
    patched(monkeypatch, spark, "membership_replicates", replicates, "gene long, is_ref boolean, inside array<double>, tested array<double>, recovered array<double>")
    monkeypatch.setitem(relations.SPARK, "ref_cosine", "SELECT * FROM (VALUES (0, 0.99e0), (1, 0.98e0), (2, 0.97e0), (3, 0.98e0), (4, 0.96e0), (5, 0.95e0), (6, 0.946e0), (7, 0.99e0)) AS t(gene, cosine)")
    patched(monkeypatch, spark, "membership", [(g, g < 8, {6: 3.9, 7: 4.1}.get(g, 1.0)) for g in range(12)], "gene long, is_ref boolean, distance double")
    patched(monkeypatch, spark, "gap_boundary", [(8, 2.0, "gap")], "n_ref long, boundary double, rule string")
    got = {r.gene: r for r in stability.stability(relations.Run(spark, SF)).collect()}
    assert {g for g, r in got.items() if r.rescued} == {6} and {g for g, r in got.items() if r.core} == set(range(6))
    assert got[0].stability == "stable" and got[9].stability == "absent"


def test_mixture_finds_planted_parts():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(70, 2)), rng.normal(size=(50, 2)) + [7, 3]])
    axes, parts = stability.subclusters(x)
    label = stability.labels(x, axes, parts)
    assert len(parts) == 2 and len(set(label[:70])) == 1 and len(set(label[70:])) == 1 and label[0] != label[-1]
    one = stability.mixture(x[:70], 1)
    assert one[1][0][1] == pytest.approx(x[:70].mean(axis=0)) and one[1][0][2] == pytest.approx(np.cov(x[:70].T, ddof=0) + stability.RIDGE * np.eye(2))
    assert len(stability.subclusters(x[:70])[1]) == 1 and len(stability.subclusters(x[:8])[1]) == 1
    assert stability.qualified(np.array([0] * 90 + [1] * 10 + [2] * 2)) == [0]


def test_two_parts_are_stable_and_an_outlier_pocket_is_none(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(60, 2)), rng.normal(size=(40, 2)) + [9, 0], rng.normal(size=(20, 2)) * 4 + [0, 60]])
    monkeypatch.setattr(stability, "SPLITS", 30)
    for n, parts in ((100, 2), (60, 1)):
        patched(monkeypatch, spark, "gene_coordinates", [(g, x[g].tolist(), True) for g in range(n)], "gene long, zs array<double>, is_ref boolean")
        got = stability.subcluster_stability(relations.Run(spark, SF)).collect()
        assert len(got) == parts and all(r.stability == "stable" and r.mean_jaccard > 0.9 for r in got) and sum(r.is_anchor for r in got) == 1 and sum(r.n for r in got) == n
    label = np.array([0] * 60 + [1] * 40)
    assert stability.matched(x[:100], label, [0, 1]) == [1.0, 1.0]
    mixed = np.array([0, 1] * 50)
    assert max(stability.matched(x[:100], mixed, [0, 1])) < 0.6


def test_bagged_estimate_is_the_mean_of_resamples(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(50, 2)), 6)
    refs = spark.createDataFrame([(g, r.tolist()) for g, r in enumerate(x)], "gene long, zs array<double>")
    centre, covariance, every = stability.bagged(refs, 50, 6)
    fits = [robust.two_passes(np.repeat(x, [drawn(i, g) for g in range(50)], axis=0)) for i in range(6)]
    assert centre == pytest.approx(np.mean([f.centre for f in fits], axis=0)) and covariance == pytest.approx(np.mean([f.covariance for f in fits], axis=0)) and len(every) == 6


def test_bagged_resamples_are_each_fitted_in_a_task(spark, monkeypatch):
    """A resample holds a little more than RESAMPLE rows as often as a little less, and is not fitted by passes then."""
    limits = []

    def fitted(rows, task_rows=robust.TASK_ROWS):
        limits.append(task_rows)
        return robust.robust(rows, task_rows=task_rows)

    monkeypatch.setattr(stability, "robust", fitted)
    refs = spark.createDataFrame([(g, [float(g % 7), float(g % 11)]) for g in range(60)], "gene long, zs array<double>")
    assert len(stability.bagged(refs, 60, 3)[2]) == 3
    assert limits[0] > stability.RESAMPLE + 20 * math.sqrt(stability.RESAMPLE)


def test_genes_are_judged_in_bounded_memory():
    rng = np.random.default_rng(3)
    n, k = 10_000, 100
    centres, covariances, bounds = rng.normal(size=(k, 8)), np.tile(np.eye(8), (k, 1, 1)), np.full((k, 1), 3.0)
    x, out = rng.normal(size=(n, 8)), rng.integers(0, 2, (n, k))
    rows = pd.DataFrame({"gene": np.arange(n), "is_ref": True, "zs": list(x), "out": list(out)})
    tracemalloc.start()
    seen = 0
    for got in stability.judged(iter([rows]), centres, covariances, bounds):
        want = np.linalg.norm(x[got.gene.to_numpy()][:, None] - centres, axis=2) <= 3.0
        assert (np.stack(got.inside) == want).all() and (np.stack(got.recovered) == want * out[got.gene.to_numpy()]).all()
        seen += len(got)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and peak < 40e6


def test_draws_are_hashed_once_in_arrays(spark):
    """What a resample leaves out is known where the genes are: no md5 of a row in the plan, and no draw is hashed again for each step of the count."""
    rows = spark.createDataFrame([(g,) for g in (-5, 0, 7, 10**15 + 1)], "gene long")
    plan = stability.resampled(rows, 3, 4, "gene")._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "MapInArrow" in plan
    for mean in (1.0, 0.2):
        assert stability.draws(2, np.array([-5, 0, 7, 10**15 + 1]), mean).tolist() == [drawn(2, g, mean) for g in (-5, 0, 7, 10**15 + 1)]


def test_a_large_reference_is_resampled_whole(spark, monkeypatch):
    """However many reference genes there are, a resample has as many draws: in the members' frequency and in the bagged estimate."""
    monkeypatch.setattr(stability, "RESAMPLE", 20)
    rows = cloud()
    patched(monkeypatch, spark, "gene_coordinates", rows, "gene long, zs array<double>, is_ref boolean")
    got = {r.gene: r for r in stability.replicates(relations.Run(spark, SF)).collect()}
    assert all(got[g].tested[i] == (drawn(i, g) == 0) for g in range(60) for i in range(stability.REPLICATES))
    refs = spark.createDataFrame([(g, z) for g, z, ref in rows if ref], "gene long, zs array<double>")
    centre, _, every = stability.bagged(refs, 60, 4)
    x = np.array([z for _, z, ref in rows if ref])
    assert every == pytest.approx(np.stack([robust.two_passes(np.repeat(x, [drawn(i, g) for g in range(60)], axis=0)).centre for i in range(4)]))


@pytest.mark.parametrize("axes", [2, 3])
def test_resamples_by_passes_are_fitted_as_in_a_task(spark, axes):
    """The steps over all rows end where those of a task do, and no row is left out."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, axes)) @ np.diag([3.0, 1.0, 2.0][:axes])
    x[:12] += 9
    rows = spark.createDataFrame([(str(i), r.tolist()) for i in range(2) for r in x[i * 20 :]], "grp string, zs array<double>")
    got = {r["grp"]: r for r in stability.fits_by_passes(rows)}
    for i in range(2):
        fit, boundary = stability.core_fit(x[i * 20 :], np.ones(300 - i * 20, int))
        assert got[str(i)]["centre"] == pytest.approx(fit.centre.tolist()) and got[str(i)]["covariance"] == pytest.approx(fit.covariance.ravel().tolist())
        assert got[str(i)]["boundary"] == pytest.approx(boundary)


def test_a_large_group_of_a_task_takes_the_steps_of_passes(monkeypatch):
    x = np.random.default_rng(6).normal(size=(2000, 3)) @ np.diag([3.0, 1.0, 2.0])
    x[:200] += 15
    whole = robust.two_passes(x)
    monkeypatch.setattr(robust, "TASK_ROWS", 1000)
    large = robust.two_passes(x)
    assert large.n == 2000 and large.outliers >= 200 and large.centre == pytest.approx(whole.centre, abs=0.05) and large.covariance == pytest.approx(whole.covariance, rel=0.1, abs=0.1)
