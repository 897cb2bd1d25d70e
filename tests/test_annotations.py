"""Annotation files against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from synonymy.sources import annotations as A
from synonymy.sources.tables import read_fasta

GFF = """##gff-version 3
c1\tp\tgene\t1\t90\t.\t+\t.\tID=gene-a1;Name=a1
c1\tp\tCDS\t1\t90\t.\t+\t0\tID=cds-a1;Parent=gene-a1
c1\tp\tCDS\t100\t190\t.\t-\t0\tID=cds-b2;locus_tag=b2
c1\tp\tCDS\tx\t190\t.\t-\t0\tID=cds-c3
c1\tp\tCDS\t200\t290\t.\t-\t0\tID=unknown
c1\tp\ttRNA\t301\t376\t.\t+\t.\tproduct=tRNA-Ala(tgc)
c1\tp\ttRNA\t401\t476\t.\t+\t.\tproduct=tRNA-Ala(tgc)
c1\tp\ttRNA\t501\t576\t.\t+\t.\tproduct=tRNA-Arg(AGC)
c1\tp\ttRNA\t601\t676\t.\t-\t.\tproduct=tRNA-fMet
c1\tp\ttRNA\t701\t776\t.\t+\t.\tproduct=tRNA-Sec(tca)
##FASTA
>c1 whole
{seq}
"""


@pytest.fixture
def gff(tmp_path):
    seq = ["G"] * 800
    seq[500 + 34 : 500 + 37] = "ACG"  # reads CGU, Arg
    seq[601 - 1 + 76 - 33 - 3 : 601 - 1 + 76 - 33] = "ATG"  # CAT on the other strand reads AUG
    (tmp_path / "g.gff").write_text(GFF.format(seq="".join(seq)))
    return str(tmp_path / "g.gff")


def test_gene_positions(spark, gff):
    genes = spark.createDataFrame([("a1",), ("b2",), ("c3",), ("z",)], "gene string")
    got = {r.gene: (r.seqid, r.start, r.end, r.strand) for r in A.gene_positions(spark, gff, genes).collect()}
    assert got == {"a1": ("c1", 1, 90, "+"), "b2": ("c1", 100, 190, "-")}
    order = spark.createDataFrame([("a1", 1), ("b2", 2)], "gene string, nth int")
    assert sorted(map(tuple, A.positions_or_order(A.gene_positions(spark, gff, genes), order).collect())) == [("a1", 1.0), ("b2", 2.0)]


def test_trna_counts(spark, gff):
    got = {(r.anticodon, r.codon): (r.aa, r.copies, r.effective) for r in A.trna_counts(spark, gff).collect()}
    assert got["TGC", "GCA"] == ("Ala", 2, 2.0) and got["TGC", "GCG"] == ("Ala", 2, pytest.approx(1.122))
    assert got["ACG", "CGU"] == ("Arg", 1, 0.9999) and got["CAT", "AUG"] == ("Met", 1, 1.0)
    assert {k[0] for k in got} == {"TGC", "ACG", "CAT"}


def test_bridges_and_names(spark, tmp_path):
    (tmp_path / "b").write_text("# map\nko:K1\tpath:ko00010\nK1\tmap00010\nK2\tpath:ko00020\n\nK1\tko00010\n")
    bridge = A.read_bridge(spark, str(tmp_path / "b"))
    assert sorted(map(tuple, bridge.collect())) == [("K1", "ko00010"), ("K2", "ko00020")]
    (tmp_path / "n").write_text("path:map00010\tGlycolysis / x\nmd:M00001\tModule\nko00020\tCycle\nmap00020\tOwn\n")
    names = {r.id: r["name"] for r in A.read_names(spark, str(tmp_path / "n")).collect()}
    assert names["ko00010"] == names["00010"] == "Glycolysis / x" and names["M00001"] == "Module" and names["ko00020"] == "Cycle" and names["map00020"] == "Own"
    genes = spark.createDataFrame([("g1", "K1"), ("g2", "K1"), ("g3", "K9")], "gene string, ko string")
    assert sorted(map(tuple, A.gene_sets(genes, bridge).collect())) == [("ko00010", "g1"), ("ko00010", "g2")]
    letters = spark.createDataFrame([("g1", "JK"), ("g2", "K"), ("g3", "?")], "gene string, letters string")
    assert sorted(map(tuple, A.letter_sets(letters).collect())) == [("J", "g1"), ("K", "g1"), ("K", "g2")]


def test_ids_labels_and_columns(spark):
    d = spark.createDataFrame([("a b.c", "x" * 40, "  Some enzyme ", 1.5), ("y" * 30, "short", "", 2.5)], "sample_id string, gene string, definition string, score double")
    tags = [r[0] for r in d.select(A.safe_locus_tag(F.col("sample_id"))).collect()]
    assert tags[0] == "a_b_c" and len(tags[1]) == 24 and tags[1].startswith("y" * 17 + "_")
    assert {r.gene: r.new_id for r in A.short_contig_ids(d).collect()} == {"x" * 40: "contig_0001", "short": "short"}
    assert [r[0] for r in d.select(A.label(F.lit("g"), F.col("definition"), 8)).collect()] == ["Some en…", "g"]
    assert A.first_column(d, ("query", "gene")) == "gene" and A.first_column(d, ("q",)) is None and A.first_column(d, ("q",), True) == "sample_id"
    assert A.named_columns(d, numeric=True) == ["score"] and "CAI" in A.rename_score(d, "CAI").columns
    names = spark.createDataFrame([("rpsA gene",), ("50S ribosomal protein L2",), ("rpoB",)], "description string")
    assert A.ribosomal(names).count() == 2


def test_tables_of_other_shapes(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b;c,d\n1;x;y\n")
    assert A.read_delimited(spark, str(tmp_path / "t.csv")).columns == ["a", "b", "c,d"]
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    assert A.read_delimited(spark, str(tmp_path / "t.tsv")).first().a == 1
    (tmp_path / "s" / "x").mkdir(parents=True)
    for name in ("s/x/g1_genome_signature.tsv", "s/g2_genome_signature.tsv"):
        (tmp_path / name).write_text(f"sample_id\tv\n{name.split('/')[-1][:2]}\t1\n")
    assert sorted(r.sample_id for r in A.read_signatures(spark, str(tmp_path / "s")).collect()) == ["g1", "g2"]
    (tmp_path / "d.tsv").write_text("id\tg1\tg2\ng1\t0\t2.5\ng2\t2.5\t0\n")
    samples = spark.createDataFrame([("g1",), ("g2",)], "sample_id string")
    assert {(r.x, r.y): r.distance for r in A.read_distances(spark, str(tmp_path / "d.tsv"), samples).collect()}["g1", "g2"] == 2.5
    assert A.read_distances(spark, str(tmp_path / "d.tsv"), spark.createDataFrame([("g3",)], "sample_id string")) is None


def test_tree_distances(spark):
    tree = "((a:1,b:2)n:0.5,(c:3,d:4.5e0):1);"
    got = {(r.x, r.y): r.distance for r in A.newick_distances(spark, tree, ["a", "b", "c", "d"]).collect()}
    assert got["a", "b"] == 3 and got["a", "c"] == pytest.approx(5.5) and got["d", "c"] == 7.5 and got["b", "b"] == 0
    assert A.newick_distances(spark, tree, ["a", "z"]) is None


def test_sample_tables(spark, tmp_path):
    for name in ("s1", "s2"):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}_enc.tsv").write_text("gene\tENC\ng\t40\n")
    assert sorted(r.sample_id for r in A.read_sample_tables(spark, str(tmp_path), "enc").collect()) == ["s1", "s2"]


def test_annotated_files(spark, gff, tmp_path):
    classes = spark.createDataFrame([("a1", "both", False), ("b2", "neither", True)], "gene string, category string, foreign boolean")
    islands = spark.createDataFrame([("c1", 5, 50, "GI_01")], "seqid string, start long, end long, island string")
    lines = [r.value for r in A.annotated_gff(spark, gff, classes, islands).collect()]
    assert lines[0].startswith("##gff") and "genomic_island" in lines[1] and "ID=GI_01" in lines[1]
    at = next(i for i, x in enumerate(lines) if "ID=cds-b2" in x)
    assert "codon_usage_class=HGT_candidate" in lines[at + 1] and lines[at + 1].endswith("hgt_mahal_flag=True")
    assert sum("codon_usage\t" in x for x in lines) == 2
    (tmp_path / "r.fna").write_text(">a1\nATG\n>b2\nATT\n")
    inside, outside = A.split_fasta(read_fasta(spark, str(tmp_path / "r.fna")), spark.createDataFrame([("a1",)], "gene string"))
    assert [r.value for r in inside.collect()] == [">a1\nATG"] and [r.value for r in outside.collect()] == [">b2\nATT"]
    a = spark.createDataFrame([("g1", "K1"), ("g1", "K0")], "gene string, ko string")
    b = spark.createDataFrame([("g2", "J")], "gene string, cog string")
    assert sorted(map(tuple, A.merged_annotations(a, b).collect()), key=str) == [("g1", "K0", None), ("g2", None, "J")]
