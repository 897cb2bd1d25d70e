"""Robust estimates and stability of the reference against plain numpy on planted data."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from synonymy.operators import moments, robust


def planted(seed, n, share, axes=3, off=12.0):
    """A cloud of known centre and covariance, and a share of rows that pull away in one direction."""
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(axes, axes))
    covariance = a @ a.T / axes + 0.3 * np.eye(axes)
    x = rng.multivariate_normal(np.arange(axes, dtype=float), covariance, n)
    bad = int(share * n)
    x[:bad] = np.arange(axes) + off * np.sqrt(np.diag(covariance)) + rng.normal(size=(bad, axes))
    return x, covariance, bad


def table(spark, x, grp="g"):
    return spark.createDataFrame([(grp, r.tolist()) for r in x], "grp string, zs array<double>")


def test_smallest_determinant_of_all_subsets():
    """On few rows the concentration steps find the subset that a search of all finds."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(9, 2)), rng.normal(size=(3, 2)) + 8])
    h = 8
    best = min(itertools.combinations(range(12), h), key=lambda s: np.linalg.det(np.cov(x[list(s)].T, ddof=0)))
    centres, covariances = robust.candidates(x, h / 12)
    centres, covariances, volumes = robust.concentrated(x, centres, covariances, h, 50)
    k = int(volumes.argmin())
    assert np.linalg.det(covariances[k]) == pytest.approx(np.linalg.det(np.cov(x[list(best)].T, ddof=0)))
    assert centres[k] == pytest.approx(x[list(best)].mean(axis=0))


def test_outliers_that_pull_a_trimmed_fit(spark):
    """30 % outliers on one side: moments trimmed once still hold many, half of the rows by determinant hold none."""
    x, covariance, bad = planted(5, 600, 0.30)
    centre, plain = robust.plain(x)
    trimmed = x[robust.squared(x, centre[None], plain[None])[0] <= moments.chi_square_quantile(0.975, 3)]
    assert np.abs(trimmed.mean(axis=0) - np.arange(3)).max() > 2
    got = robust.robust(table(spark, x), kept=0.55)["g"]
    assert np.abs(got.centre - np.arange(3)).max() < 0.25
    assert np.abs(got.covariance - covariance).max() < 0.35 * np.abs(covariance).max()
    assert bad <= got.outliers <= bad + 0.08 * (len(x) - bad) and got.n == 600


def test_passes_equal_one_task(spark):
    """Spark's steps over a group that is too large for a task give the estimate of one task."""
    x, covariance, bad = planted(6, 3000, 0.08, axes=2)
    y, _, _ = planted(7, 2500, 0.0, axes=2)
    rows = table(spark, x, "x").union(table(spark, y, "y")).union(table(spark, y[:40], "few"))
    want, got = robust.robust(rows), robust.robust(rows, task_rows=1000)
    assert set(got) == {"x", "y", "few"} and np.array_equal(got["few"].centre, want["few"].centre)
    for g in ("x", "y"):
        assert got[g].centre == pytest.approx(want[g].centre, abs=0.05) and got[g].covariance == pytest.approx(want[g].covariance, abs=0.08)
    assert np.abs(got["x"].centre - [0, 1]).max() < 0.15 and got["x"].outliers >= bad and np.abs(got["x"].covariance - covariance).max() < 0.3 * np.abs(covariance).max()


def test_few_rows_and_equal_rows(spark):
    assert robust.robust(table(spark, np.zeros((0, 2)))) == {}
    one = robust.robust(table(spark, np.ones((1, 2))))["g"]
    assert one.n == 1 and one.centre.tolist() == [1, 1]
    x = np.random.default_rng(1).normal(size=(6, 2))
    few = robust.robust(table(spark, x))["g"]
    assert few.centre == pytest.approx(x.mean(axis=0)) and few.covariance == pytest.approx(np.cov(x.T)) and few.outliers == 0
    same = robust.robust(table(spark, np.full((40, 2), 3.0)))["g"]
    assert same.centre.tolist() == [3, 3] and np.abs(same.covariance).max() < 1e-9
    half = np.concatenate([np.zeros((30, 2)), np.random.default_rng(2).normal(size=(30, 2))])
    assert np.isfinite(robust.robust(table(spark, half))["g"].centre).all()


def test_membership_rests_on_the_robust_fit(spark):
    from synonymy.plans import registry

    got = registry.QUERIES["mv12_cluster_genes"](spark, "/root/testdata/sf0.01").where(F.col("is_ref"))
    assert got.count() > 20 and 0.85 < got.agg(F.avg(F.col("in_cluster").cast("double"))).first()[0] < 0.95


def test_passes_send_sums_and_distances_alone(spark):
    """A step's passes hand on no row's vector, and its moments and bounds are those of the rows in each group."""
    x, covariance, _ = planted(9, 500, 0.1, axes=2)
    y, _, _ = planted(10, 300, 0.0, axes=2)
    rows = table(spark, x, "x").union(table(spark, y, "y")).union(table(spark, y[:5], "other")).repartition(7)
    fits = {"x": (np.array([[0.0, 1.0], [0.2, 0.9]]), np.stack([covariance, np.eye(2)])), "y": (np.array([[0.0, 1.0]]), np.eye(2)[None])}
    bounds = robust._bounds(rows, fits, 0.6)
    assert set(bounds) == {"x|0", "x|1", "y|0"}
    got = robust._kept(rows, fits, bounds)
    for g, z in (("x", x), ("y", y)):
        for k, d in enumerate(robust.squared(z, *fits[g])):
            assert bounds[f"{g}|{k}"] == np.sort(d)[int(np.ceil(0.6 * len(z))) - 1]
            inside = z[d <= bounds[f"{g}|{k}"]]
            assert got[g][0][k] == pytest.approx(inside.mean(axis=0)) and got[g][1][k] == pytest.approx(np.cov(inside.T, ddof=0))
    clean = robust._within(rows, {"x": (fits["x"][0][0], covariance)}, 4.0)
    assert "MapInPandas" not in clean._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, (r.zs for r in clean.collect()))) == sorted(map(tuple, x[robust.squared(x, fits["x"][0][:1], covariance[None])[0] <= 4.0].tolist()))


def test_the_reference_is_fitted_once(spark, monkeypatch):
    """Membership and the dual anchor read one fit of the reference."""
    from synonymy.operators import density, multivariate
    from synonymy.plans import registry, relations  # noqa: F401

    fitted = []
    monkeypatch.setattr(multivariate, "_robust", lambda rows, axes, f=multivariate._robust: fitted.append(axes) or f(rows, axes))
    monkeypatch.setattr(density, "_robust", multivariate._robust)
    relations.clear(spark)
    run = relations.Run(spark, "/root/testdata/sf0.01")
    n = run("membership").count()
    assert len(fitted) == 1 and density.dual_anchor(run).count() == n > 20 and len(fitted) == 2
