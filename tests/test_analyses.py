import pytest

from synonymy.plans import analyses, registry, relations
from synonymy.sources import shared

SF = "/root/testdata/sf0.001"


def test_analyses_name_queries():
    assert {q for qs in analyses.ANALYSES.values() for q in qs} <= set(registry.QUERIES)
    with pytest.raises(SystemExit):
        analyses.options(["nothing", "--tables", "a", "--out", "b"])
    assert analyses.options(["usage", "--tables", "a", "--out", "b"]).format == "parquet"


def test_tables_are_written(spark, tmp_path):
    paths = analyses.write(spark, SF, "signatures", str(tmp_path), "tsv")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["sg01_gene_signature", "sg02_genome_signature"]
    assert spark.read.option("header", True).option("sep", "\t").csv(paths[0]).count() > 0


def test_names_are_read_after_from_and_join_only():
    text = "SELECT med, best AS pair, (SELECT max(enc) FROM scores) AS enc FROM metric m JOIN tier ON tier.gene = m.gene"
    assert relations.names(text) == ["scores", "metric", "tier"]


def test_views_of_the_caller_stay(spark):
    spark.range(3).createOrReplaceTempView("documents")
    assert registry.QUERIES["pf01_min_length"](spark, SF).count() > 0
    assert spark.table("documents").count() == 3
    spark.catalog.dropTempView("documents")


def test_kept_relations_follow_their_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(150).write.parquet(f"{tmp_path}/documents.parquet")
    q = registry.QUERIES["ag01_codon_counts"]
    few = q(spark, str(tmp_path)).select("gene").distinct().count()
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert q(spark, str(tmp_path)).select("gene").distinct().count() > few


def test_a_query_reads_the_sequences_once(spark):
    for name in ("st09_fisher", "mv19_robust_z", "st11_length_bias"):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "documents.parquet" not in plan and "Generate" not in plan.replace("Generate explode(sequence", "")


def test_scratch_can_be_cleared(spark):
    folder = shared.new_folder(spark, "test")
    shared.written(spark.range(3), f"{folder}/x")
    relations.clear(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/x").count()
    assert registry.QUERIES["ag07_gc3"](spark, SF).count() > 0
