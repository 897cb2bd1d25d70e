"""Formulas against plain Python from the texts on: a second formulation, not the relations' text."""

import math
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from synonymy.operators import multivariate
from synonymy.plans import registry, relations

SF = "/root/testdata/sf0.001"
BASES = "UCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
AA = dict(zip(map("".join, product(BASES, repeat=3)), AMINO, strict=True))
SENSE = [c for c in AA if AA[c] not in "*MW"]
#: Six-fold amino acids are a family of four and one of two.
FAMILY = {c: AA[c] + (c[:2] if AA[c] in "LRS" else "") for c in SENSE}
SIZE = Counter(FAMILY.values())


class Genes:
    """All of it from the tables, gene by gene."""

    def __init__(self, spark):
        self.seq, self.sample, self.cond, self.genome = {}, {}, {}, {}
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
            s = re.sub("[^ACGT]", "", (r.text or "").upper()) if re.search("[ACGTacgt]", r.text or "") else ""
            s = "".join(c for c in r.text or "" if c in "ACGTacgt").upper()
            if len(s) >= 240:
                self.seq[r.doc_id], self.sample[r.doc_id], self.cond[r.doc_id], self.genome[r.doc_id] = s.replace("T", "U"), f"{r.source}-{r.lang}", r.lang, r.source
        self.codons = {g: [s[i : i + 3] for i in range(0, len(s) - 2, 3)] for g, s in self.seq.items()}
        self.n = {g: Counter(c) for g, c in self.codons.items()}
        labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
        self.ref = [r.doc_id for r in labels if r.quality == 1 and r.doc_id in self.seq]
        self.goi = [r.doc_id for r in labels if r.toxic == 1 and r.doc_id in self.seq]
        self.all = self.pool(self.n)
        self.pooled_ref = self.pool(self.ref)

    def pool(self, genes):
        out = Counter()
        for g in genes:
            out.update(self.n[g])
        return out


def rscu(n):
    total = Counter()
    for c in SENSE:
        total[FAMILY[c]] += n[c]
    return {c: n[c] * SIZE[FAMILY[c]] / total[FAMILY[c]] if total[FAMILY[c]] else None for c in SENSE}


def weights(n):
    r, best = rscu(n), defaultdict(float)
    for c in SENSE:
        best[FAMILY[c]] = max(best[FAMILY[c]], r[c] or 0)
    return {c: max(r[c] / best[FAMILY[c]], 1e-3) for c in SENSE if r[c] is not None and best[FAMILY[c]]}


def folds():
    size = Counter(AA[c] for c in SENSE)
    return size, Counter(size.values())


def effective(n, f_of):
    size, families = folds()
    mean = defaultdict(list)
    for aa in size:
        cs = [c for c in SENSE if AA[c] == aa]
        if sum(n[c] for c in cs) > 1:
            mean[size[aa]].append(f_of(aa, [n[c] for c in cs], cs))
    total = 2.0
    for k, m in families.items():
        f = sum(mean[k]) / len(mean[k]) if mean[k] else 0
        total += m / f if f > 0 else m * k
    return min(61.0, total)


def wright(aa, ns, cs):
    n = sum(ns)
    return (n * sum((x / n) ** 2 for x in ns) - 1) / (n - 1)


@pytest.fixture(scope="module")
def genes(spark):
    return Genes(spark)


def rows(spark, name):
    return registry.QUERIES[name](spark, SF).collect()


def test_hand_counted_usage():
    even, one = Counter({"UUU": 50, "UUC": 50}), Counter({c: 30 for c in ("UUU", "CUG")})
    assert rscu(even)["UUU"] == rscu(even)["UUC"] == 1 and rscu(one)["CUG"] == 4 and rscu(one)["UUA"] is None
    assert effective(Counter({c: 1000 for c in SENSE}), wright) > 60.5
    assert effective(Counter({min(c for c in SENSE if AA[c] == a): 100 for a in set(AA[c] for c in SENSE)}), wright) == 20


def test_usage_by_gene(spark, genes):
    got = {(r.gene, r.rscu_col.split("-")[1]): r.rscu for r in rows(spark, "ag02_rscu_gene")}
    want = {(g, c): x for g, n in genes.n.items() for c, x in rscu(n).items()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (x is None) and (x is None or got[k] == pytest.approx(x, abs=1e-6)) for k, x in want.items())


def test_usage_by_sample(spark, genes):
    want = {}
    for s in set(genes.sample.values()):
        for c, x in rscu(genes.pool([g for g in genes.seq if genes.sample[g] == s])).items():
            want[s, c] = x
    got = {(r.sample_id, r.codon): r.rscu for r in rows(spark, "ag05_rscu_pooled")}
    assert got == {k: x and pytest.approx(x, abs=1e-6) for k, x in want.items()}


def test_effective_numbers(spark, genes):
    got = {r.gene: r.enc for r in rows(spark, "ag06_enc")}
    assert got == {g: pytest.approx(effective(n, wright), abs=1e-5) for g, n in genes.n.items()}


def test_third_positions(spark, genes):
    got = {r.gene: (r.gc12, r.gc3) for r in rows(spark, "ag08_gc12_gc3")}
    for g, cs in genes.codons.items():
        gc = [sum(c[i] in "GC" for c in cs) for i in range(3)]
        assert got[g] == (pytest.approx((gc[0] + gc[1]) / 2 / len(cs), abs=1e-6), pytest.approx(gc[2] / len(cs), abs=1e-6))


def test_expression_scores(spark, genes):
    w, size = weights(genes.pooled_ref), folds()[0]

    def share(pool):
        total = Counter()
        for c in SENSE:
            total[AA[c]] += pool[c]
        return {c: pool[c] / total[AA[c]] if total[AA[c]] else 0 for c in SENSE}

    f_all, f_ref = share(genes.all), share(genes.pooled_ref)

    def milc(n, f):
        total, aa = sum(n[c] for c in SENSE), Counter()
        for c in SENSE:
            aa[AA[c]] += n[c]
        g = sum(2 * n[c] * math.log(n[c] / (aa[AA[c]] * f[c])) for c in SENSE if n[c] and f[c] > 0)
        r = sum(n[c] > 0 for c in SENSE) - len({AA[c] for c in SENSE if n[c]})
        return g / total - (r / total - 0.5)

    def prime(aa, ns, cs):
        n = sum(ns)
        x2 = sum(n * (x / n - f_all[c]) ** 2 / f_all[c] for x, c in zip(ns, cs, strict=True) if f_all[c] > 0)
        return (n + x2 - size[aa]) / (size[aa] * (n - 1))

    got = {r.gene: r for r in rows(spark, "ag24_expression_scores")}
    for g, n in genes.n.items():
        used = sum(n[c] for c in w)
        r = got[g]
        assert r.cai == pytest.approx(math.exp(sum(n[c] * math.log(w[c]) for c in w) / used), abs=1e-5)
        assert r.fop == pytest.approx(sum(n[c] for c in w if w[c] >= 1) / used, abs=1e-5)
        assert r.milc == pytest.approx(milc(n, f_all), abs=1e-5)
        assert r.melp == pytest.approx(milc(n, f_all) / milc(n, f_ref), abs=1e-4)
        assert r.encprime == pytest.approx(effective(n, prime), abs=1e-4)


def test_codon_bias_and_optimal_codons(spark, genes):
    a, r, size = rscu(genes.all), rscu(genes.pooled_ref), folds()[0]
    weight = {c: math.log((r[c] + 0.01) / (a[c] + 0.01)) for c in SENSE if r[c] is not None and a[c] is not None}
    optimal = {}
    for aa in size:
        ranked = sorted((c for c in weight if AA[c] == aa), key=lambda c: (-weight[c], c))
        if ranked and (len(ranked) == 1 or weight[ranked[0]] - weight[ranked[1]] > 1e-6):
            optimal[aa] = ranked[0]
    assert {r.codon for r in rows(spark, "ag15_optimal_codons")} == set(optimal.values())
    got = {r.gene: (r.n_total, r.n_optimal, r.cbi) for r in rows(spark, "ag16_cbi")}
    for g, n in genes.n.items():
        total, best = sum(n[c] for c in SENSE if AA[c] in optimal), sum(n[c] for c in optimal.values())
        chance = sum(n[c] / size[AA[c]] for c in SENSE if AA[c] in optimal)
        if total:
            assert got[g] == (total, best, pytest.approx(0 if total - chance <= 0 else (best - chance) / (total - chance), abs=1e-4))


def test_codon_pairs(spark, genes):
    coding = [c for c in AA if AA[c] != "*"]
    pairs, per_gene = Counter(), {}
    for g, cs in genes.codons.items():
        per_gene[g] = Counter((x, y) for x, y in zip(cs, cs[1:], strict=False) if x in coding and y in coding)
        pairs.update(per_gene[g])
    aa_n, pair_aa = Counter(), Counter()
    for c in coding:
        aa_n[AA[c]] += genes.all[c]
    for (x, y), k in pairs.items():
        pair_aa[AA[x], AA[y]] += k
    cps = {(x, y): math.log(k / (genes.all[x] * genes.all[y] / (aa_n[AA[x]] * aa_n[AA[y]]) * pair_aa[AA[x], AA[y]])) for (x, y), k in pairs.items()}
    assert {(r.a, r.b): (r.n, r.cps) for r in rows(spark, "ag18_cps")} == {k: (pairs[k], pytest.approx(x, abs=1e-5)) for k, x in cps.items()}
    assert {r.gene: r.cpb for r in rows(spark, "ag19_gene_cpb")} == {g: pytest.approx(sum(k * cps[p] for p, k in n.items()) / sum(n.values()), abs=1e-5) for g, n in per_gene.items() if n}


def test_top_line_takes_the_median_over_codons(spark, genes):
    a, r = weights(genes.all), weights(genes.pooled_ref)
    raw = lambda n: {c: x / max(y for d, y in rscu(n).items() if FAMILY[d] == FAMILY[c] and y is not None) for c, x in rscu(n).items() if x is not None}
    a, r = raw(genes.all), raw(genes.pooled_ref)
    shift = [abs(a[c] - r[c]) for c in SENSE if c in a and c in r]
    got = rows(spark, "co03_top_line")[0]
    assert got.median_shift == pytest.approx(float(np.median(shift)), abs=1e-6) and got.max_shift == pytest.approx(max(shift), abs=1e-6)


# ---------------------------------------------------------------- tests between groups
def patched(monkeypatch, name, rows, columns):
    show = lambda x: f"'{x}'" if isinstance(x, str) else "CAST(NULL AS DOUBLE)" if x is None else f"{x}D" if isinstance(x, float) else str(x)
    monkeypatch.setitem(relations.RELATIONS, name, "SELECT * FROM VALUES " + ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows) + f" AS t({columns})")


def mann_whitney(x, y):
    every = list(x) + list(y)
    u = sum((a > b) + 0.5 * (a == b) for a in x for b in y)
    n, tie = len(every), sum(c**3 - c for c in Counter(every).values())
    var = len(x) * len(y) / 12 * ((n + 1) - tie / (n * (n - 1)))
    z = max(abs(u - len(x) * len(y) / 2) - 0.5, 0) / math.sqrt(var)
    return u, math.erfc(z / math.sqrt(2)), 2 * u / (len(x) * len(y)) - 1


def test_two_sample_form(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 9, 14) / 4, rng.integers(2, 12, 11) / 4
    patched(monkeypatch, "tier_cpb", [("cpb", "high", "low", 1, float(v)) for v in x] + [("cpb", "high", "low", 0, float(v)) for v in y], "item, g1, g2, first_one, v")
    got = rows(spark, "st15_cpb_by_tier")[0]
    u, p, delta = mann_whitney(x, y)
    assert (got.u, got.p, got.delta) == (pytest.approx(u), pytest.approx(p, abs=2e-6), pytest.approx(delta, abs=1e-6))


def test_adjustment_within_groups(spark, monkeypatch):
    ps = [0.01, 0.04, 0.03, 0.005, None, 0.5]
    patched(monkeypatch, "class_split", [(f"i{k}", "a", "b", 9.0, 9.0, 1.0, 1.0, 0.0, p, c, f"i{k}") for c in ("x", "y") for k, p in enumerate(ps if c == "x" else ps[:3])], "item, g1, g2, n1, n2, m1, m2, delta, p, class, codon")
    got = {(r["class"], r.codon): r.q for r in rows(spark, "st19_class_rscu_between")}
    assert [got["x", f"i{k}"] for k in range(6)] == [pytest.approx(0.025), pytest.approx(0.05), pytest.approx(0.05), pytest.approx(0.025), None, pytest.approx(0.5)]
    assert [got["y", f"i{k}"] for k in range(3)] == [pytest.approx(0.03), pytest.approx(0.04), pytest.approx(0.04)]


def enrichment(hits, n, w):
    """The running sum, step by step."""
    out, total = [0.0], sum(w[r] for r in hits)
    for r in range(1, n + 1):
        out.append(out[-1] + (w[r] / total if r in hits else -1 / (n - len(hits))))
    return max(out) if max(out) >= -min(out) else min(out)


def test_enrichment_walk(spark, monkeypatch):
    rng = np.random.default_rng(2)
    n = 120
    w = {r: float(x) for r, x in enumerate(np.round(rng.uniform(0.1, 2, n), 3), 1)}
    member = {r: "top" if r < 30 and r % 3 else "low" if r > 90 else f"mix{r % 2}" for r in range(1, n + 1)}
    patched(monkeypatch, "ranked", [(r, member[r], w[r], r, n) for r in w], "gene, genome, w, r, n")
    monkeypatch.delitem(relations.SPARK, "ranked")
    sets = {s: {r for r in member if member[r] == s} for s in set(member.values())}
    assert {r.gene_set: r.es for r in rows(spark, "rs10_enrichment_score")} == {s: pytest.approx(enrichment(h, n, w), abs=1e-6) for s, h in sets.items()}
    got = {r.gene_set: r for r in rows(spark, "rs11_preranked_gsea")}
    assert got["top"].es > 0 and got["top"].p <= 0.002 and got["top"].fdr < 0.05 and got["top"].nes > 1.5
    assert got["low"].es < 0 and got["low"].p <= 0.002 and got["low"].nes < -1.5
    peak = max(range(1, n + 1), key=lambda r: sum(w[x] for x in sets["top"] if x <= r) / sum(w[x] for x in sets["top"]) - sum(x not in sets["top"] for x in range(1, r + 1)) / (n - len(sets["top"])))
    assert got["top"].leading_edge_size == sum(x <= peak for x in sets["top"])


def test_partition_enrichment(spark, monkeypatch):
    parts = [(k, int(k < 12), "cluster" if k % 3 == 0 or k < 8 else "outlier" if k % 3 == 1 else "bulk") for k in range(60)]
    patched(monkeypatch, "parts", parts, "gene, is_goi, part")
    got = {r.category: r for r in rows(spark, "st29_partition_enrichment")}
    for c in ("cluster", "outlier", "bulk"):
        a, k = sum(g for _, g, p in parts if p == c), sum(p == c for _, _, p in parts)
        ways = {x: math.comb(k, x) * math.comb(60 - k, 12 - x) for x in range(max(0, k + 12 - 60), min(k, 12) + 1)}
        assert got[c].p == pytest.approx(sum(v for v in ways.values() if v <= ways[a]) / math.comb(60, 12), abs=1e-6)
    x2 = sum((sum(1 for _, g, p in parts if p == c and g == v) - sum(p == c for _, _, p in parts) * (12 if v else 48) / 60) ** 2 / (sum(p == c for _, _, p in parts) * (12 if v else 48) / 60) for c in ("cluster", "outlier", "bulk") for v in (0, 1))
    assert got["OMNIBUS"].odds_ratio == pytest.approx(math.sqrt(x2 / 60), abs=1e-6) and got["OMNIBUS"].p == pytest.approx(math.exp(-x2 / 2), abs=1e-6)


# ---------------------------------------------------------------- many variables
def test_correspondence_analysis(spark, genes):
    x = np.array([[rscu(genes.n[g])[c] or 0 for c in sorted(SENSE)] for g in sorted(genes.n)])
    total = x.sum()
    e = np.outer(x.sum(axis=1), x.sum(axis=0)) / total
    s = np.where(e > 0, (x - e) / np.sqrt(np.where(e > 0, e * total, 1)), 0)
    u, sigma, vt = np.linalg.svd(s, full_matrices=False)
    inertia = rows(spark, "mv01_coa_inertia")
    assert [r.eigenvalue for r in inertia] == pytest.approx((sigma[: len(inertia)] ** 2).tolist(), abs=1e-9)
    assert [r.pct_inertia for r in inertia] == pytest.approx((sigma**2 / (sigma**2).sum() * 100)[: len(inertia)].tolist(), abs=1e-6)
    assert inertia[0].broken_stick_pct == pytest.approx(sum(1 / j for j in range(1, min(x.shape) + 1)) / min(x.shape) * 100)
    at = {(r.gene, r.axis): r.coordinate for r in rows(spark, "mv01_coa_genes")}
    for k in range(2):
        sign = np.sign(vt[k][np.abs(vt[k]).argmax()])
        want = u[:, k] * sigma[k] * sign / np.sqrt(x.sum(axis=1) / total)
        assert [at[g, k + 1] for g in sorted(genes.n)] == pytest.approx(want.tolist(), abs=1e-6)


def test_membership(spark, genes):
    got = {r.gene: r for r in rows(spark, "mv12_cluster_genes")}
    refs = [r.distance for r in got.values() if r.is_ref]
    cut = float(np.percentile(refs, 90))
    for r in got.values():
        assert r.threshold == pytest.approx(cut, abs=1e-5)
        assert r.membership == pytest.approx(1 / (1 + math.exp((r.distance - cut) / (cut / 5))), abs=1e-4)
        assert r.in_cluster == (r.distance <= r.threshold) and r.weight == pytest.approx(max(1 - r.distance / cut, 0), abs=1e-4)
    assert {g for g, r in got.items() if r.is_ref} == set(genes.ref)


def ledoit_wolf(x):
    n, p = x.shape
    x = x - x.mean(axis=0)
    s = x.T @ x / n
    mu = np.trace(s) / p
    delta = ((s - mu * np.eye(p)) ** 2).sum() / p
    beta = min(sum(((np.outer(r, r) - s) ** 2).sum() for r in x) / n / n / p, delta)
    return (1 - beta / delta) * s + beta / delta * mu * np.eye(p), beta / delta


def test_foreign_genes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    independent = sorted(r[0] for r in relations.codon_rows() if r[7])
    x = rng.normal(1, 0.3, (80, len(independent)))
    x[:3] += 4
    vector = lambda v: "array(" + ", ".join(f"{float(a)}D" for a in v) + ")"
    monkeypatch.delitem(relations.SPARK, "gene_codons")
    monkeypatch.setitem(relations.RELATIONS, "gene_codons", "SELECT * FROM VALUES " + ", ".join(f"({i}L, 's', 'g', 'c', array(0D), {vector(v)}, true)" for i, v in enumerate(x)) + " AS t(gene, sample_id, genome, cond, xs, ind, whole)")
    patched(monkeypatch, "gc", [(i, "s", "g", "c", 0.5 + (i == 9) * 0.4 + i % 2 * 0.01) for i in range(80)], "gene, sample_id, genome, cond, gc3")
    got = {r.gene: r for r in rows(spark, "mv05_foreign_genes") if r.scope == "genome"}
    cov, shrinkage = ledoit_wolf(x)
    d = x - x.mean(axis=0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert [got[i].distance for i in range(80)] == pytest.approx(want.tolist(), abs=1e-4) and got[0].shrinkage == pytest.approx(shrinkage, abs=1e-5)
    half = want**2 / 2
    tail = np.array([sum(math.exp(k * math.log(h) - h - math.lgamma(k + 1)) for k in range(19)) for h in half])
    assert [got[i].p for i in range(80)] == pytest.approx(tail.tolist(), abs=1e-5)
    assert {i for i in got if got[i].gc3_outlier} == {9} and sum(r.flag_adaptive for r in got.values()) == 4


def test_fewer_genes_than_codons():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12, 38))
    z = x - x.mean(axis=0)
    k, s, inverse = multivariate._shrunk(12, x.mean(axis=0), z.T @ z / 12, float(((z**2).sum(axis=1) ** 2).sum()))
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    cov, shrinkage = ledoit_wolf(z @ vt[:11].T)
    p = z @ vt[:11].T
    assert k == 11 and s == pytest.approx(shrinkage)
    assert np.einsum("ij,jk,ik->i", z, inverse, z) == pytest.approx(np.einsum("ij,jk,ik->i", p, np.linalg.inv(cov), p))


def test_chi_square_bounds():
    for df, bound in ((1, 3.841459), (2, 5.991465), (5, 11.0705), (38, 53.38354)):
        assert multivariate.chi_square_quantile(0.95, df) == pytest.approx(bound, abs=1e-4)


def test_regions_of_peaks():
    x = np.array([0.1, 0.1, 0.5, 0.9, 0.5, 0.1, 0.1, 0.12, 0.1, 0.1, 0.6, 0.6, 0.1])
    assert multivariate.peaks(x) == [3, 10] and multivariate.regions(x) == [(2, 4), (10, 11)]
    assert multivariate.regions(np.ones(10)) == [] and multivariate.smoothed(np.ones(9)) == pytest.approx(np.ones(9))


def test_islands_in_divergent_stretches(spark, monkeypatch):
    placed = [(g, "g", 300, "+", 1 + 300 * g) for g in range(600)]
    patched(monkeypatch, "placed", placed, "gene, genome, length, strand, start_bp")
    monkeypatch.delitem(relations.SPARK, "membership")
    patched(monkeypatch, "membership", [(g, 0.05 if 240 <= g < 330 else 0.9) for g in range(600)], "gene, membership")
    got = rows(spark, "be06_divergence_islands")
    # Bins 8 to 10, and what smoothing carries on each side.
    assert len(got) == 1 and 4 <= got[0].first_bin <= 8 and 10 <= got[0].last_bin <= 14


def test_clusters_and_drivers(spark):
    got = rows(spark, "mv20_sample_clusters")
    assert len(got) == len({r.sample_id for r in got}) and 2 <= len({r.cluster for r in got}) <= 8
    axes = np.array([(r.pc1, r.pc2) for r in rows(spark, "mv24_sample_components")])
    assert np.abs(axes.mean(axis=0)).max() < 1e-5 and axes[:, 0].var() >= axes[:, 1].var() and abs(np.corrcoef(axes.T)[0, 1]) < 1e-4


def test_density_and_its_peaks(spark):
    from pyspark.sql import functions as F

    from synonymy.operators.density import Density

    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (600, 2)), rng.normal([9, 2], 1, (400, 2))])
    rows = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "gene long, zs array<double>").select("gene", "zs", F.lit(True).alias("is_ref"))
    field = Density(rows)
    places = [p for p, _ in field.peaks()]
    assert len(places) == 2 and np.abs(places[0]).max() < 0.6 and np.abs(places[1] - [9, 2]).max() < 0.7
    at = {r.gene: r.density for r in field.of(rows, ["gene"]).collect()}
    cov = np.cov(x.T) * len(x) ** (-1 / 3)
    d = x[:20, None] - x[None]
    want = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", d, np.linalg.inv(cov), d)).sum(axis=1) / (2 * math.pi * math.sqrt(np.linalg.det(cov)) * len(x))
    assert [at[i] for i in range(20)] == pytest.approx(want.tolist(), rel=0.1)


def test_stability_votes_and_groups(spark):
    got = rows(spark, "mv15_membership_stability")
    assert got and all(0 <= r.frequency <= 1 and r.core == (r.frequency >= 0.5) for r in got) and not any(r.rescued and (r.core or not r.is_ref) for r in got)
    whole = rows(spark, "mv15_stability_metrics")[0]
    assert whole.n_core_genes == sum(r.core or r.rescued for r in got) and whole.n_rescued == sum(r.rescued for r in got) and whole.n_replicates == 100
    assert whole.ref_coverage == pytest.approx(np.mean([r.core for r in got if r.is_ref]), abs=1e-6) and whole.cluster_frac == pytest.approx(np.mean([r.frequency for r in got]), abs=1e-5)
    assert whole.composite_score == pytest.approx(0.4 * whole.mean_jaccard + 0.3 * whole.mean_core_freq + 0.3 * whole.cosine_sim, abs=1e-5) and 0 < whole.mean_oob_recovery <= 1
    member = {r.gene: r.in_cluster for r in rows(spark, "mv12_cluster_genes")}
    often = [r.frequency for r in got if member[r.gene]]
    assert np.mean(often) > np.mean([r.frequency for r in got if not member[r.gene]])
    assert {r.category for r in rows(spark, "mv14_dual_anchor")} <= {"both", "rp_only", "dens_only", "neither"}
    votes = rows(spark, "mv13_selection_votes")
    assert len({r.classification for r in votes}) == 1 and len(votes) == 3
    mixtures = rows(spark, "mv10_reference_mixtures")
    assert [r.k for r in mixtures] == [1, 2, 3, 4] and sum(r.chosen for r in mixtures) == 1 and min(mixtures, key=lambda r: r.bic).chosen
    sizes = {}
    for r in rows(spark, "mv23_goi_clusters"):
        sizes[r.cluster] = sizes.get(r.cluster, 0) + 1
    assert not sizes or len(sizes) >= 1


def test_pathways_between_conditions(spark, monkeypatch):
    cases = [(f"s{c}{k}", c, "p", 0.001 if c == "a" and k < 6 or c == "b" and k < 1 else 0.9) for c in "abc" for k in range(8)]
    monkeypatch.delitem(relations.SPARK, "sample_terms")
    patched(monkeypatch, "sample_terms", cases, "sample_id, cond, pathway, p")
    got = {(r.test, r.g1, r.g2): r for r in rows(spark, "st20_pathways_between")}
    fisher = sum(math.comb(8, x) * math.comb(8, 7 - x) for x in range(8) if math.comb(8, x) * math.comb(8, 7 - x) <= math.comb(8, 6) * math.comb(8, 1)) / math.comb(16, 7)
    assert got["fisher", "a", "b"].p == pytest.approx(fisher, abs=1e-6)
    x2 = sum((o - 7 / 3) ** 2 / (7 / 3) + ((8 - o) - 17 / 3) ** 2 / (17 / 3) for o in (6, 1, 0))
    assert got["chi_square", "", ""].statistic == pytest.approx(x2, abs=1e-5) and got["chi_square", "", ""].p == pytest.approx(math.exp(-x2 / 2), abs=1e-6)


def test_gap_boundary(spark, monkeypatch):
    axes = sum(r.chosen for r in rows(spark, "mv01_coa_inertia"))
    low, high = (math.sqrt(multivariate.chi_square_quantile(p, axes)) for p in (0.90, 0.99))
    edge = (low + high) / 2
    distances = [low * (k + 1) / 61 for k in range(60)] + [edge, edge + 2.5, edge + 2.6]
    monkeypatch.delitem(relations.SPARK, "membership")
    patched(monkeypatch, "membership", [(k, d, "true") for k, d in enumerate(distances)], "gene, distance, ref")
    monkeypatch.setitem(relations.RELATIONS, "membership", relations.RELATIONS["membership"].replace("SELECT *", "SELECT gene, distance, ref = 'true' AS is_ref"))
    got = rows(spark, "wn13_gap_boundary")[0]
    assert got.n_ref == 63 and got.rule == "gap" and got.boundary == pytest.approx(edge + 1.25)
