"""Pairs of neighbouring codons against plain Python and the relation's SQL."""

from collections import Counter

from synonymy.functions.codons import codon_rows
from synonymy.operators import pairs
from synonymy.plans import registry, relations  # noqa: F401  the registry defines all relations
from synonymy.sources.tables import cds_from_documents, codon_positions

CODING = {r[0] for r in codon_rows() if r[6]}


def test_pairs_of_odd_sequences(spark, monkeypatch):
    rows = [(7, "ATGAAATAAAAAATGC"), (8, ""), (9, "ATG"), (10, "CCCGGGCCCGGGCC"), (11, "TAATAGTGA")]
    monkeypatch.setitem(relations.SPARK, "cds", relations.needs()(lambda run: spark.createDataFrame(rows, "gene long, seq string").coalesce(1)))
    got = {(r.gene, r.a, r.b): r.n for r in pairs.pair(relations.Run(spark, "")).collect()}
    want = Counter()
    for gene, seq in rows:
        codons = [seq[i : i + 3].replace("T", "U") for i in range(0, len(seq) - 2, 3)]
        want.update((gene, a, b) for a, b in zip(codons, codons[1:], strict=False) if {a, b} <= CODING)
    assert got == want and len(want) == 4


def test_pairs_are_those_of_the_sql_without_a_shuffle(spark, monkeypatch):
    run = relations.Run(spark, "/root/testdata/sf0.001")
    got = run._fresh("pair")
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.delitem(relations.SPARK, "pair")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, run._fresh("pair").collect()))


ARRAYS = "genes cl grid rscu aa_n milc gene_clr".split()


def rows_of(run, name):
    df = run._fresh(name)
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.drop("present").collect()), key=str)


def by_sql(monkeypatch):
    for name in ARRAYS:
        monkeypatch.delitem(relations.SPARK, name)


def test_usage_in_arrays_is_that_of_the_sql_without_a_shuffle_of_codons(spark, monkeypatch):
    run = relations.Run(spark, "/root/testdata/sf0.001")
    for name in ("cl", "rscu", "aa_n", "gene_codons", "gene_clr"):
        plan = run._fresh(name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan, name
    got = {n: rows_of(run, n) for n in ARRAYS}
    by_sql(monkeypatch)
    for n in ARRAYS:
        assert len(got[n]) > 50 and got[n] == rows_of(run, n), n


def test_usage_of_odd_rows(spark, monkeypatch):
    long = "acgtTTGGAA" * 30
    rows = [(1, long, "en", "web"), (1, long + "CCC", "en", "web"), (2, "x" * 500, "en", "web"), (3, None, "en", "web"), (None, long, "de", None), (4, "é" + "GCA" * 80 + "GC", None, "web"), (5, "GCA" * 79, "en", "web")]
    monkeypatch.setitem(relations.SPARK, "documents", relations.needs()(lambda run: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    monkeypatch.setattr(relations, "KEPT", set())
    run = relations.Run(spark, "")
    monkeypatch.setitem(relations.SPARK, "cds", relations.needs("documents")(lambda run: cds_from_documents(run("documents"))))
    got = {n: rows_of(run, n) for n in ("genes", "cl", "rscu")}
    for n in ("genes", "cl", "grid", "rscu"):
        monkeypatch.delitem(relations.SPARK, n)
    monkeypatch.setitem(relations.SPARK, "codon_pos", relations.needs("cds")(lambda run: codon_positions(run("cds"), "gene", "sample_id", "genome", "cond")))
    assert {r[0] for r in got["genes"]} == {1, 4, None} and len(got["genes"]) == 4
    for n, some in got.items():
        assert some == rows_of(run, n), n
