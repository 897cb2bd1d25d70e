"""SQL functions, readers in parts, and exact rank tests."""

import itertools

import pytest

from synonymy.functions import sql
from synonymy.operators import statistics
from synonymy.plans import registry, relations
from synonymy.sources import annotations


def test_functions_in_sql(spark):
    assert set(sql.register(spark)) == set(sql.FUNCTIONS) and sql.register(spark)
    one = spark.sql("SELECT rna('acgT') AS a, revcomp('AACg') AS b, codons_of('atgaaata') AS c, gc_share('GGAA') AS d, gc3_share('ATGAAAGGC') AS e, wright_enc(0.5e0) AS f, effect_label(0.4e0) AS g, gc_share('') AS h, codons_of(NULL) AS i").first()
    assert (one.a, one.b, one.c, one.d, one.f, one.g, one.h, one.i) == ("ACGU", "cGTT", ["AUG", "AAA"], 0.5, 60.5, "medium", None, None) and one.e == pytest.approx(2 / 3)
    spark.createDataFrame([(1, "atgatgaaa"), (2, "gg")], "gene long, seq string").createOrReplaceTempView("some_cds")
    got = spark.sql("SELECT s.gene, t.pos, t.codon FROM some_cds s, LATERAL codon_positions(s.seq) t ORDER BY pos").collect()
    assert [tuple(r) for r in got] == [(1, 1, "AUG"), (1, 2, "AUG"), (1, 3, "AAA")]
    assert {tuple(r) for r in spark.sql("SELECT codon, n FROM codon_counts('atgatgaaa')").collect()} == {("AUG", 2), ("AAA", 1)}


def gff(n):
    lines = ["##gff-version 3"]
    for i in range(n):
        lines.append(f"c{i % 3}\tx\tCDS\t{i * 50 + 1}\t{i * 50 + 40}\t.\t{'+-'[i % 2]}\t0\tID=g{i};locus_tag=t{i}")
    lines += ["##FASTA"]
    for c in range(3):
        lines.append(f">c{c} contig {c}")
        lines += ["ACGTACGTAA" * 6] * (40 + c)
    return "\n".join(lines) + "\n"


def test_parts_of_a_file_read_as_one(spark, tmp_path):
    """Small splits give what one split gives: features above, sequences below the mark, in their order."""
    path = tmp_path / "genome.gff"
    path.write_text(gff(300))
    genes = spark.range(300).selectExpr("concat('g', id) AS gene")

    def read():
        positions = {tuple(r) for r in annotations.gene_positions(spark, str(path), genes).collect()}
        return positions, {tuple(r) for r in annotations.contig_sequences(spark, str(path)).collect()}

    whole = read()
    assert len(whole[0]) == 300 and {(s, len(x)) for s, x in whole[1]} == {(f"c{c}", 60 * (40 + c)) for c in range(3)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 8))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.text(str(path)).rdd.getNumPartitions() >= 8
        assert read() == whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exact_tails_count_all_orders(spark, monkeypatch):
    for m, n in ((2, 3), (4, 4), (5, 7)):
        counts = [0] * (m * n + 1)
        for places in itertools.combinations(range(m + n), m):
            counts[sum(p - i for i, p in enumerate(places))] += 1
        assert statistics.u_counts(m, n) == counts
    first, second = [1.0, 2.0, 3.5, 4.0, 9.0], [2.5, 5.0, 6.0, 7.0, 8.0, 10.0]
    values = [("s", "x", "y", 1, v) for v in first] + [("s", "x", "y", 0, v) for v in second]
    values += [("tied", "x", "y", 1, float(int(v))) for v in first] + [("tied", "x", "y", 0, float(int(v))) for v in second]
    monkeypatch.setitem(relations.SPARK, "metric_two", relations.needs()(lambda run: spark.createDataFrame(values, "item string, g1 string, g2 string, first_one int, v double")))
    got = {r.item: r for r in relations.Run(spark, "/root/testdata/sf0.01")("metric_test").collect()}
    u = sum(a > b for a in first for b in second)
    far, every = max(u, 30 - u), list(itertools.combinations(range(11), 5))
    want = min(1.0, 2 * sum(sum(p - i for i, p in enumerate(x)) >= far for x in every) / len(every))
    assert got["s"].u == u and got["s"].p == pytest.approx(want)
    assert got["tied"].p != pytest.approx(want) and 0 < got["tied"].p <= 1
    assert "u_exact" in registry.SQL["st16_between_conditions"]


def test_manifests_by_their_own_separator_and_checked_files(spark, tmp_path):
    from synonymy.sources import tables

    for sep in "\t,;|":
        path = tmp_path / f"m{ord(sep)}.txt"
        path.write_text(sep.join(("genome_path", "cond")) + "\n" + sep.join(("/x/one.fna", "a")) + "\n")
        assert [tuple(r) for r in tables.read_manifest(spark, str(path)).select("sample_id", "cond").collect()] == [("one", "a")]
    faa, ffn, none = tmp_path / "a.faa", tmp_path / "a.ffn", tmp_path / "b.ffn"
    faa.write_text(">p1\nMK\n>p2\nMA\n")
    ffn.write_text(">p1\nATG\n")
    none.write_text("")
    assert tables.checked_genome(spark, {"faa": str(faa), "ffn": str(ffn)}) == 2
    for files, error in (({"faa": str(faa)}, ValueError), ({"faa": str(faa), "ffn": str(tmp_path / "no")}, FileNotFoundError), ({"faa": str(faa), "ffn": str(none)}, ValueError)):
        with pytest.raises(error):
            tables.checked_genome(spark, files)


def test_options_set_parameters(monkeypatch):
    from synonymy.operators import stability
    from synonymy.plans import analyses

    o = analyses.options(["cluster", "--tables", "t", "--out", "o", "--resamples", "7", "--core-threshold", "0.8"])
    assert o.resamples == 7 and o.core_threshold == 0.8 and o.bagged_resamples == stability.BAGGED
    assert all(q in registry.QUERIES for queries in analyses.ANALYSES.values() for q in queries)


def test_the_class_falls_back_to_metrics_that_have_tiers(spark, monkeypatch):
    def of(flat):
        values = [(g, m, float(g), "medium" if m in flat else "high" if g > 8 else "low" if g < 2 else "medium") for g in range(10) for m in ("MELP", "CAI", "Fop")]
        monkeypatch.setitem(relations.SPARK, "tiers", relations.needs()(lambda run: spark.createDataFrame(values, "gene long, metric string, v double, tier string")))
        monkeypatch.setattr(relations, "KEPT", relations.KEPT - {"tiers"})
        return {r.gene: r.expression_class for r in registry.QUERIES["ag23_expression_table"](spark, "/root/testdata/sf0.001").collect()}, {r[0]: r[3] for r in values if r[1] == next((m for m in ("MELP", "CAI", "Fop") if m not in flat), "MELP")}

    for flat in ((), ("MELP",), ("MELP", "CAI"), ("MELP", "CAI", "Fop")):
        got, want = of(flat)
        assert got == want
