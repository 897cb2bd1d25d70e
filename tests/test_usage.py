import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from synonymy.functions.codons import codon_dim, codon_rows, effect_label, reverse_complement, wright_enc
from synonymy.operators.statistics import erfc
from synonymy.plans import registry, relations
from synonymy.sources import tables
from synonymy.streaming.counts import codon_counts

SF = "/root/testdata/sf0.001"


def test_codon_dimension():
    rows = codon_rows()
    assert len(rows) == 64
    assert sum(r[5] for r in rows) == 59
    assert len({r[2] for r in rows if r[5]}) == 21
    assert sum(r[7] for r in rows) == 38
    assert len({r[0][:2] for r in rows if r[8]}) == 8


def test_scalar_functions(spark):
    row = spark.createDataFrame([("ACGTNacgt", 0.5)], "s string, g double").select(reverse_complement(F.col("s")).alias("r"), wright_enc(F.col("g")).alias("w"), effect_label(F.lit(0.2)).alias("e")).first()
    assert row.r == "acgtNACGT" and row.w == pytest.approx(60.5) and row.e == "small"


def test_erfc(spark):
    got = spark.range(0, 60).selectExpr("id / 10 AS x", f"{erfc('id / 10e0')} AS y").collect()
    assert all(abs(r.y - math.erfc(float(r.x))) < 2e-7 for r in got)


def test_fasta_gff_and_ids(spark, tmp_path):
    (tmp_path / "g1.fna").write_text(">a first gene\nATGAAA\nTTTTAA\n>b\nATG\n")
    got = {r.gene: (r.sample_id, r.seq) for r in tables.read_fasta(spark, str(tmp_path / "g1.fna")).collect()}
    assert got == {"a": ("g1", "ATGAAATTTTAA"), "b": ("g1", "ATG")}
    assert tables.read_fasta(spark, str(tmp_path / "g1.fna"), 5).count() == 1
    (tmp_path / "x.gff").write_text("##gff-version 3\nc1\tp\tCDS\t1\t9\t.\t+\t0\tID=a;Name=n\n")
    row = tables.read_gff(spark, str(tmp_path / "x.gff")).first()
    assert (row.seqid, row.start, row.end, row.strand, row.attrs["ID"]) == ("c1", 1, 9, "+", "a")
    (tmp_path / "ids").write_text("# c\na x\nb\na\n")
    assert sorted(r.gene for r in tables.read_ids(spark, str(tmp_path / "ids")).collect()) == ["a", "b"]


def test_manifest_needs_a_path(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("genome_path\tsite\n/x/e.coli.fna\ts\n")
    assert tables.read_manifest(spark, str(tmp_path / "m.tsv")).first().sample_id == "e.coli"
    (tmp_path / "n.tsv").write_text("path\n/x\n")
    with pytest.raises(ValueError):
        tables.read_manifest(spark, str(tmp_path / "n.tsv"))


def test_stream_counts_equal_batch(spark):
    docs = tables.table(spark, SF, "documents")
    live = spark.readStream.schema(docs.schema).format("parquet").option("pathGlobFilter", "documents.parquet").load(SF)
    q = codon_counts(live).writeStream.outputMode("complete").format("memory").queryName("live_codons").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("live_codons").collect())) == sorted(map(tuple, codon_counts(docs).collect()))


def test_rscu_sums_to_family_size(spark):
    got = registry.QUERIES["ag02_rscu_gene"](spark, SF)
    dim = codon_dim(spark).select(F.concat_ws("-", "family", "codon").alias("rscu_col"), "family", "ffold")
    sums = got.join(dim, "rscu_col").groupBy("gene", "family").agg(F.sum("rscu").alias("s"), F.max("ffold").alias("k")).where("s is not null")
    assert sums.where("abs(s - k) > 1e-3").count() == 0 and sums.count() > 0


@pytest.mark.parametrize("name", ["ag04_codon_frequency", "ag06_enc", "ag16_cbi", "ag18_cps", "ag24_expression_scores", "wn09_percentile_rank", "st16_kruskal_wallis", "rs10_enrichment_score", "be04_strand_asymmetry"])
def test_queries_match_reference_sql(spark, name):
    con = duckdb.connect()
    for t in tables.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    a, b = registry.QUERIES[name](spark, SF).toPandas(), con.execute(registry.SQL[name]).df()
    a, b = a[sorted(a.columns)], b[sorted(b.columns)]
    key = lambda df: sorted(repr(tuple(None if v is None or v != v else round(float(v), 5) + 0.0 if not isinstance(v, str) else v for v in r)) for r in df.itertuples(index=False))
    assert list(a.columns) == list(b.columns) and key(a) == key(b)


def choose_tail(n, c, s, keep):
    """Sum of hypergeometric chances that are kept, from exact integers."""
    ways = {x: math.comb(c, x) * math.comb(n - c, s - x) for x in range(max(0, c + s - n), min(c, s) + 1)}
    return sum(w for x, w in ways.items() if keep(x, ways)) / math.comb(n, s)


def test_fisher_of_more_than_30000_genes(spark, monkeypatch):
    monkeypatch.setitem(relations.RELATIONS, "tier", "SELECT id AS gene, CASE WHEN id < 400 OR id % 3 = 0 THEN 'a' ELSE 'b' END AS genome, CASE WHEN id % 100 = 0 OR id = 7 THEN 'high' WHEN id % 50 = 1 THEN 'low' ELSE 'medium' END AS tier FROM range(33000)")
    got = {(r.category, r.tier): r for r in registry.QUERIES["st09_fisher"](spark, SF).collect()}
    assert len(got) == 4
    for (_, tier), r in got.items():
        total = 331 if tier == "high" else 660
        want = choose_tail(33000, r.n_total, total, lambda x, ways, a=r.n_in_tier: ways[x] <= ways[a])
        assert r.p == pytest.approx(want, abs=1e-6)


def test_hypergeometric_of_a_universe_above_30000(spark, monkeypatch):
    monkeypatch.setitem(relations.RELATIONS, "hyper", "SELECT 'a' AS pathway, 50L AS n, 15L AS k, 40000L AS m, 8000L AS nn UNION ALL SELECT 'b', 3L, 0L, 40000L, 8000L")
    got = {r.pathway: r.p for r in registry.QUERIES["st07_hypergeometric"](spark, SF).collect()}
    assert got["a"] == pytest.approx(choose_tail(40000, 50, 8000, lambda x, _: x >= 15), abs=1e-6) and got["b"] == 1


def test_strong_effects_reach_one_in_a_thousand(spark, monkeypatch):
    monkeypatch.setitem(relations.RELATIONS, "clr", "SELECT 's' || s.id AS sample_id, CASE WHEN s.id < 20 THEN 'a' ELSE 'b' END AS cond, 'c' || c.id AS codon, CASE WHEN s.id < 20 THEN 1e0 ELSE -1e0 END + s.id * 1e-3 AS x FROM range(40) s CROSS JOIN range(3) c")
    assert registry.QUERIES["st25_permanova"](spark, SF).first().p == 0.001
    # 20 genes of interest, all foreign; CAI says nothing.
    monkeypatch.setitem(relations.RELATIONS, "binned", "SELECT id AS gene, CASE WHEN id < 20 THEN 1 ELSE 0 END AS is_goi, 5e-1 AS cai, 4e1 AS enc, CAST(id % 4 AS INT) AS bin FROM range(200)")
    monkeypatch.setitem(relations.RELATIONS, "foreign_gene", "SELECT id AS gene, id < 20 OR id % 7 = 0 AS flag FROM range(200)")
    got = registry.QUERIES["rs06_matched_permutation"](spark, SF).first()
    assert (got.observed, got.p_more, got.p_less) == (1, 0.001, 1) and 0.1 < got.null_mean < 0.2


def test_draws_are_whole_and_fill_short_bins(spark, monkeypatch):
    # Bin 0: 50 of interest and 8 others, bin 1: 30 and 5000.
    monkeypatch.setitem(relations.RELATIONS, "binned", "SELECT id AS gene, CASE WHEN id < 80 THEN 1 ELSE 0 END AS is_goi, CAST(id AS DOUBLE) AS cai, 4e1 AS enc, CASE WHEN id < 50 OR id BETWEEN 80 AND 87 THEN 0 ELSE 1 END AS bin FROM range(5088)")
    got = registry.QUERIES["rs03_length_matched"](spark, SF).collect()
    assert len(got) == 999 and {r.n for r in got} == {80}
    # 50 draws around 83.5 and 30 around 2587.5.
    assert sum(r.mean_cai for r in got) / 999 == pytest.approx((50 * 83.5 + 30 * 2587.5) / 80, rel=0.02)
    words = {i: sorted((hashlib.md5(f"{i}-{g}".encode()).hexdigest(), g) for g in range(88, 5088))[:30] for i in (0, 998)}
    means = {r.iter: r.mean_cai for r in got}
    for i, lowest in words.items():
        short = [80 + int(hashlib.md5(f"{i}-0-{k}".encode()).hexdigest()[:15], 16) % 8 for k in range(1, 51)]
        assert means[i] == pytest.approx((sum(short) + sum(g for _, g in lowest)) / 80, abs=1e-5)


@pytest.mark.parametrize("sizes", [(6, 7, 5, 2), (6, 5, 8), (5, 6, 7, 8), (5, 5, 6, 5, 7), (6, 5, 5, 7, 5, 5, 4)])
def test_kruskal_wallis_of_any_groups(spark, monkeypatch, sizes):
    rows = [(f"g{g}", (7 * k + 3 * g * g) % 11 + g / 4) for g, n in enumerate(sizes) for k in range(n)]
    monkeypatch.setitem(relations.RELATIONS, "sample_metric", "SELECT 's' AS sample_id, cond, 'x' AS metric, v FROM VALUES " + ", ".join(f"('{c}', {v}D)" for c, v in rows) + " AS t(cond, v)")
    got = registry.QUERIES["st16_kruskal_wallis"](spark, SF).first()
    kept = [(c, v) for c, v in rows if sizes[int(c[1:])] >= 5]
    n, df, every = len(kept), sum(k >= 5 for k in sizes) - 1, [v for _, v in kept]
    rank = {v: sum(x < v for x in every) + (every.count(v) + 1) / 2 for v in every}
    total = {c: [rank[v] for d, v in kept if d == c] for c, _ in kept}
    h = (12 / (n * (n + 1)) * sum(sum(r) ** 2 / len(r) for r in total.values()) - 3 * (n + 1)) / (1 - sum(every.count(v) ** 3 - every.count(v) for v in set(every)) / (n**3 - n))
    # The density of chi-square from h on, by Simpson's rule.
    f = lambda x: x ** (df / 2 - 1) * math.exp(-x / 2) / (2 ** (df / 2) * math.gamma(df / 2))
    xs = [h + k / 50 for k in range(10001)]
    p = sum(f(x) * (1 if k in (0, 10000) else 4 if k % 2 else 2) for k, x in enumerate(xs)) / 150
    assert got.n_groups == df + 1 and got.h == pytest.approx(h, abs=1e-6) and got.p == pytest.approx(p, abs=2e-6)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name, row_bytes", [("cl", 32), ("gene_clr", 32), ("set_clr", None)])
def test_the_planner_knows_which_side_grows(spark, name, row_bytes):
    """Spark broadcasts what it takes for small: rows made from arrays must not count as the compressed files they come from, and what has a row a codon must."""
    rows = relations.Run(spark, "/root/testdata/sf0.01")(name)
    taken = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert taken >= row_bytes * rows.count() if row_bytes else taken < 1_000_000
