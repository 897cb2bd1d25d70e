"""Queries over the computed cluster, and enrichment by sample, against plain Python."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from synonymy.operators import enrichment
from synonymy.plans import registry, relations

SF = "/root/testdata/sf0.01"


def rows(spark, name):
    return registry.QUERIES[name](spark, SF).collect()


def relation(spark, name):
    return relations.Run(spark, SF)(name).collect()


@pytest.fixture(scope="module")
def member(spark):
    return {r.gene: r for r in rows(spark, "mv12_cluster_genes")}


def test_partition_and_pivots_rest_on_the_cluster(spark, member):
    foreign = {r.gene for r in rows(spark, "mv05_foreign_genes") if r.scope == "genome" and r.flag}
    want = {g: "cluster" if g in member and member[g].in_cluster else "outlier" if g in foreign else "bulk" for g in (r.gene for r in relation(spark, "scores"))}
    assert {r.gene: r.part for r in rows(spark, "gs03_cluster_partition")} == want
    assert {r.gene: r.foreign_flag for r in rows(spark, "gs02_goi_foreign")} == {r.gene: r.gene in foreign for r in rows(spark, "gs02_goi_summary")}
    assert {r.gene: r.part for r in rows(spark, "gs03_partition")} != want
    goi = {r.gene for r in relation(spark, "goi")}
    parts = defaultdict(int)
    for g, p in want.items():
        parts[p] += g in goi
    assert {r.category: r.n_goi for r in rows(spark, "st29_cluster_enrichment") if r.category != "OMNIBUS"} == dict(parts)
    assert len(rows(spark, "rs06_foreign_permutation")) == 1 and len(rows(spark, "rs07_cluster_permutation")) == 1


def test_cluster_frame_counts_the_cluster(spark, member):
    counts, family = defaultdict(int), {}
    for r in relation(spark, "grid"):
        family[r.codon] = r.family
        if r.gene in member and member[r.gene].in_cluster:
            counts[r.codon] += r.n
    got = {r.codon: r for r in rows(spark, "co01_cluster_table")}
    for c, r in got.items():
        own = [counts[x] for x in family if family[x] == family[c]]
        assert r.rscu_ref == pytest.approx(counts[c] * len(own) / sum(own), abs=1e-5) and r.w_ref == pytest.approx(counts[c] / max(own), abs=1e-5)
    first = {r.codon: r.rscu_ref for r in rows(spark, "co01_three_way_table")}
    assert any(abs(first[c] - r.rscu_ref) > 1e-4 for c, r in got.items())
    assert len(rows(spark, "ag31_cluster_cai")) == len(rows(spark, "ag31_three_way_cai"))


def test_inefficiency_ranks_by_thresholds(spark, member):
    got = sorted(rows(spark, "be16_inefficiency_ratio"), key=lambda r: r.rank)
    outside = [g for g, r in member.items() if not r.in_cluster]
    assert {r.gene for r in got} == set(outside) & {r.gene for r in relation(spark, "scores")} and [r.rank for r in got] == list(range(1, len(got) + 1))
    assert all(a.ratio >= b.ratio for a, b in zip(got, got[1:], strict=False)) and all(r.ratio == pytest.approx(member[r.gene].distance / member[r.gene].threshold, abs=1e-4) and r.ratio > 1 for r in got)


def score(hits, weights):
    """Enrichment score by the walk over all ranks."""
    total, miss, run, best = sum(weights[r] for r in hits), len(weights) - len(hits), 0.0, 0.0
    for r in range(len(weights)):
        run += weights[r] / total if r in hits else -1 / miss
        if abs(run) > abs(best) + 1e-12 or (abs(abs(run) - abs(best)) <= 1e-12 and run > best):
            best = run
    return best


def test_enrichment_of_each_sample(spark):
    weight, sample = {r.gene: r.v + 1e-6 for r in relation(spark, "gene_burden")}, defaultdict(list)
    for r in relation(spark, "genes"):
        if r.gene in weight:
            sample[r.sample_id].append(r.gene)
    sets = defaultdict(set)
    for r in relation(spark, "set_gene"):
        sets[r.source, r.gene_set].add(r.gene)
    got = {(r.sample_id, r.source, r.gene_set): r for r in rows(spark, "be14_sample_gsea")}
    want = {}
    for s, genes in sample.items():
        genes = sorted(genes, key=lambda g: (-weight[g], g))
        weights = [weight[g] for g in genes]
        nulls = {}
        for (source, name), members in sets.items():
            hits = {i for i, g in enumerate(genes) if g in members}
            if not enrichment.LEAST_HITS <= len(hits) < len(genes):
                continue
            if len(hits) not in nulls:
                nulls[len(hits)] = []
                for i in range(enrichment.ORDERS):
                    order = sorted(range(len(genes)), key=lambda k: (hashlib.md5(f"{i}-{genes[k]}".encode()).hexdigest(), genes[k]))
                    nulls[len(hits)].append(score(set(order[: len(hits)]), weights))
            null, es = np.round(nulls[len(hits)], 9), round(score(hits, weights), 9)
            side = [x for x in null if (x >= 0) == (es >= 0)]
            p = (1 + sum(x >= es if es >= 0 else x <= es for x in null)) / (1 + len(null))
            want[s, source, name] = (es, es / abs(np.mean(side)) if side else None, p)
    assert set(got) == set(want) and len(want) > 100
    for k, (es, nes, p) in want.items():
        assert got[k].es == pytest.approx(es, abs=2e-6) and got[k].p == pytest.approx(p, abs=1e-2)
        assert got[k].nes is None if nes is None else got[k].nes == pytest.approx(nes, abs=1e-2)
    matrix = registry.QUERIES["jn05_score_matrix"](spark, SF)
    wide = {(s, r.gene_set): r[s] for r in matrix.collect() for s in matrix.columns if s != "gene_set" and r[s] is not None}
    assert wide == {(s, f"{source} {name}"): r.nes for (s, source, name), r in got.items() if r.nes is not None}


def test_enrichment_has_no_upper_bound(spark, monkeypatch):
    """Sets of more than 500 genes are tested."""
    many = spark.range(4000).selectExpr("id AS gene", "concat('s', id % 3) AS genome", "1e0 / (1 + id) AS w", "id + 1 AS r", "4000L AS n")
    monkeypatch.setitem(relations.SPARK, "ranked", relations.needs()(lambda run: many))
    monkeypatch.setattr(relations, "KEPT", relations.KEPT - {"set_es_e", "null_es"})
    got = rows(spark, "rs10_enrichment_score")
    assert sorted(r["size"] for r in got) == [1333, 1333, 1334]
