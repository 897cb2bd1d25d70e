"""Enrichment of every sample in one plan, its matrix, and its comparison between conditions; pivots over what the data hold.

A sample's genes are ranked by their burden of rare codons, the heaviest first.  Its gene
sets are pathways and letters.  Sets of one size share a null: the first genes of random
orders of the sample.  All is keyed by sample; on Spark ranks and orders are cut into
ranges, so a large sample is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.operators.comparisons import adjusted, kruskal, two_sample, walk
from synonymy.operators.ranking import ordered
from synonymy.plans.relations import KEPT, Run, needs, on_spark, query, relation

#: Random orders of each sample, and genes that a set needs in a sample. The tables' samples are small, so few are asked for.
ORDERS, LEAST_HITS = 200, 2

relation("gene_burden", "SELECT c.gene, round(sum(CASE WHEN w.w < 3e-1 THEN c.n * (1e0 - w.w) ELSE 0e0 END) / sum(c.n), 9) AS v FROM cl c JOIN w_ref w USING (codon) GROUP BY c.gene")
# A little more than the burden, so that a set of genes without any has a walk.
relation("sample_burdens", "SELECT g.sample_id, g.cond, g.gene, b.v + 1e-6 AS w FROM gene_burden b JOIN genes g ON g.gene = b.gene")
relation("sample_ranked", "SELECT sample_id, cond, gene, w, row_number() OVER (PARTITION BY sample_id ORDER BY w DESC, gene) AS r, count(*) OVER (PARTITION BY sample_id) AS n FROM sample_burdens")
relation("set_gene", "SELECT DISTINCT 'pathway' AS source, pathway AS gene_set, gene FROM gene_ko UNION ALL SELECT DISTINCT 'letter' AS source, substr(p_type, 1, 1) AS gene_set, p_partkey AS gene FROM part")
relation("sample_hits", "SELECT s.sample_id, k.source, k.gene_set, s.r, s.w, s.n FROM sample_ranked s JOIN set_gene k ON k.gene = s.gene")
walk("sample_set_es", "sample_hits", "sample_id, source, gene_set")

relation("sample_orders", f"SELECT CAST(i AS BIGINT) AS i FROM range(0, {ORDERS}) AS t(i)")
relation("sample_shuffled", """SELECT s.sample_id, t.i, s.r, s.w, s.n, row_number() OVER (PARTITION BY s.sample_id, t.i ORDER BY md5(CAST(t.i AS VARCHAR(20)) || '-' || CAST(s.gene AS VARCHAR(20))), s.gene) AS k FROM sample_ranked s CROSS JOIN sample_orders t""")
relation("sample_sizes", f"SELECT DISTINCT sample_id, size FROM sample_set_es WHERE size >= {LEAST_HITS}")
relation("sample_null_hits", "SELECT x.sample_id, x.i, z.size AS drawn, x.r, x.w, x.n FROM sample_shuffled x JOIN sample_sizes z ON z.sample_id = x.sample_id AND x.k <= z.size")
walk("sample_null_es", "sample_null_hits", "sample_id, i, drawn")
relation("sample_null_mean", "SELECT sample_id, drawn, avg(CASE WHEN es >= 0 THEN es END) AS up, avg(CASE WHEN es < 0 THEN -es END) AS down FROM sample_null_es GROUP BY sample_id, drawn")
relation("sample_nes", f"""SELECT s.sample_id, s.source, s.gene_set, s.size, s.es, round(CASE WHEN s.es >= 0 THEN s.es / nullif(m.up, 0) ELSE s.es / nullif(m.down, 0) END, 4) AS nes
  FROM sample_set_es s JOIN sample_null_mean m ON m.sample_id = s.sample_id AND m.drawn = s.size WHERE s.size >= {LEAST_HITS}""")
relation("sample_nes_p", """SELECT s.sample_id, s.source, s.gene_set, round((1e0 + count(CASE WHEN (s.es >= 0 AND n.es >= s.es) OR (s.es < 0 AND n.es <= s.es) THEN 1 END)) / (1e0 + count(*)), 6) AS p
  FROM sample_nes s JOIN sample_null_es n ON n.sample_id = s.sample_id AND n.drawn = s.size GROUP BY s.sample_id, s.source, s.gene_set""")
relation("sample_nes_q0", "SELECT s.sample_id, s.source, s.gene_set, s.size, s.es, s.nes, p.p FROM sample_nes s JOIN sample_nes_p p ON p.sample_id = s.sample_id AND p.source = s.source AND p.gene_set = s.gene_set")
adjusted("sample_nes_q", "sample_nes_q0", "sample_id, source", "gene_set")
query("be14_sample_gsea", "SELECT sample_id, source, gene_set, CAST(size AS BIGINT) AS size, round(es, 6) AS es, nes, p, round(q, 6) AS q FROM sample_nes_q")
# p has six digits, so q often lies halfway between two of them: rounded as the reference rounds, by the product.
on_spark("be14_sample_gsea", "SELECT sample_id, source, gene_set, CAST(size AS BIGINT) AS size, round(es, 6) AS es, nes, p, round(q * 1e6) / 1e6 AS q FROM sample_nes_q")

relation("nes_by", "SELECT s.source || ' ' || s.gene_set AS item, c.cond AS grp, s.nes AS v FROM sample_nes s JOIN (SELECT DISTINCT sample_id, cond FROM genes) c ON c.sample_id = s.sample_id WHERE s.nes IS NOT NULL")
relation("nes_two", "SELECT b.item, p.g1, p.g2, CASE WHEN b.grp = p.g1 THEN 1 ELSE 0 END AS first_one, b.v FROM nes_by b JOIN pair_of_conds p ON b.grp = p.g1 OR b.grp = p.g2")
two_sample("nes_test", "nes_two", 2)
kruskal("nes_kw", "nes_by", 2)
relation("nes_all", "SELECT 'mann_whitney' AS test, item, g1, g2, u AS statistic, m1, m2, p FROM nes_test UNION ALL SELECT 'kruskal_wallis' AS test, item, '' AS g1, '' AS g2, h AS statistic, CAST(NULL AS DOUBLE) AS m1, CAST(NULL AS DOUBLE) AS m2, p FROM nes_kw")
adjusted("nes_q", "nes_all", "test", "item, g1, g2")
query("st32_nes_between_conditions", "SELECT test, item AS gene_set, g1, g2, round(statistic, 4) AS statistic, round(m1, 4) AS mean_nes_1, round(m2, 4) AS mean_nes_2, round(p, 6) AS p, round(q, 6) AS q, q < 5e-2 AS significant FROM nes_q")


@needs("sample_burdens")
def sample_ranked(run: Run) -> DataFrame:
    rows = ordered(run("sample_burdens"), F.col("sample_id"), F.col("w").desc(), F.col("gene")).drop("n")
    return within(rows, ["sample_id"], "r", "n")


def within(rows: DataFrame, by: list[str], place: str, size: str | None = None) -> DataFrame:
    """Global places (r) made places within groups that lie together in the order; and the groups' sizes."""
    first = rows.groupBy(*by).agg((F.min("r") - 1).alias("first_"), F.count("*").alias("size_"))
    out = rows.join(first, by).withColumn("place_", F.col("r") - F.col("first_")).drop("r", "first_").withColumnRenamed("place_", place)
    return out.withColumnRenamed("size_", size) if size else out.drop("size_")


on_spark("sample_ranked", sample_ranked)
KEPT.update({"sample_ranked", "sample_set_es", "sample_null_es", "sample_nes"})

# ---------------------------------------------------------------- pivots
query("jn05_score_matrix", "SELECT * FROM (PIVOT (SELECT source || ' ' || gene_set AS gene_set, sample_id, nes FROM sample_nes) ON sample_id USING max(nes) GROUP BY gene_set)")
query("jn04_condition_pivot", "SELECT * FROM (PIVOT (SELECT codon, cond, v FROM sample_codon) ON cond USING round(coalesce(avg(v), 0e0), 6) GROUP BY codon)")
query("ag36_crosstab", "SELECT * FROM (PIVOT (SELECT pathway, tier, gene FROM tier_pathway) ON tier USING count(gene) GROUP BY pathway)")
relation("tier_pathway", "SELECT k.pathway, t.tier, t.gene FROM tier t JOIN (SELECT DISTINCT gene, pathway FROM gene_ko) k ON k.gene = t.gene")
query("ag35_text_lists", """SELECT pathway, count(DISTINCT ko) AS n_ko, string_agg(DISTINCT ko, ';' ORDER BY ko) AS kos FROM gene_ko GROUP BY pathway""")
on_spark("ag35_text_lists", "SELECT pathway, count(DISTINCT ko) AS n_ko, array_join(array_sort(collect_set(ko)), ';') AS kos FROM gene_ko GROUP BY pathway")


@needs("sample_nes")
def score_matrix(run: Run) -> DataFrame:
    """gene_set and a column of NES for each sample that the data hold."""
    return run("sample_nes").withColumn("gene_set", F.concat_ws(" ", "source", "gene_set")).groupBy("gene_set").pivot("sample_id").agg(F.max("nes"))


@needs("sample_codon")
def condition_pivot(run: Run) -> DataFrame:
    """codon and a column of mean usage for each condition that the data hold."""
    return run("sample_codon").groupBy("codon").pivot("cond").agg(F.round(F.coalesce(F.avg("v"), F.lit(0.0)), 6))


@needs("tier_pathway")
def crosstab(run: Run) -> DataFrame:
    """pathway and a column of gene counts for each tier that the data hold."""
    return run("tier_pathway").groupBy("pathway").pivot("tier").agg(F.count("gene")).na.fill(0)


for name, form in (("jn05_score_matrix", score_matrix), ("jn04_condition_pivot", condition_pivot), ("ag36_crosstab", crosstab)):
    on_spark(name, form)
