"""The queries that read a set of reference genes, tiers or flags, over the computed cluster and foreign genes.

Their first forms, which other engines run too, take a label of the tables for the cluster,
genes of deviating GC3 for foreign ones and the high tier for the third frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.operators import comparisons, genomics, statistics, usage  # noqa: F401  they define the first forms
from synonymy.operators.multivariate import foreign_genes
from synonymy.operators.ranking import ordered
from synonymy.plans.relations import KEPT, Run, needs, on_spark, spark_query, variant

on_spark("foreign_table", foreign_genes)
KEPT.add("foreign_table")
on_spark("cluster_set", "SELECT gene FROM membership WHERE in_cluster")
on_spark("cluster_tier", "SELECT gene, 'high' AS tier FROM membership WHERE in_cluster")
on_spark("foreign_flags", "SELECT g.gene, g.genome, g.gc3, coalesce(f.flag, false) AS flag FROM gc g LEFT JOIN (SELECT gene, flag FROM foreign_table WHERE scope = 'genome') f ON f.gene = g.gene")

CLUSTER, FOREIGN = {"refset": "cluster_set"}, {"foreign_gene": "foreign_flags"}
for name, new, swap in (
    ("gs02_goi_summary", "gs02_goi_foreign", FOREIGN), ("gs03_partition", "gs03_cluster_partition", CLUSTER | FOREIGN), ("st29_partition_enrichment", "st29_cluster_enrichment", CLUSTER | FOREIGN),
    ("rs06_matched_permutation", "rs06_foreign_permutation", FOREIGN), ("rs07_membership_permutation", "rs07_cluster_permutation", CLUSTER), ("cm02_sample_table", "cm02_foreign_table", FOREIGN),
    ("co01_three_way_table", "co01_cluster_table", CLUSTER), ("co02_optimization_summary", "co02_cluster_summary", CLUSTER), ("co03_top_line", "co03_cluster_top_line", CLUSTER), ("co04_recommendation", "co04_cluster_recommendation", CLUSTER),
    ("ag31_three_way_cai", "ag31_cluster_cai", {"tier": "cluster_tier"}), ("co05_gene_gain", "co05_cluster_gain", {"tier": "cluster_tier"}), ("be03_mobile_elements", "be03_foreign_mobile", FOREIGN),
):
    variant(name, new, swap)


@needs("membership", "scores", "gene_ko", "path_q")
def inefficiency(run: Run) -> DataFrame:
    """rank, gene, ko, cai, ratio, pathways, priority: genes outside the cluster by how many thresholds away they are; pathways: those enriched in a tier that a gene is in; priority: within them."""
    rows = run.sql("""SELECT m.gene, m.distance / nullif(m.threshold, 0) AS ratio, s.cai, coalesce(k.kos, '') AS ko, coalesce(k.pathways, '') AS pathways FROM membership m JOIN scores s ON s.gene = m.gene
  LEFT JOIN (SELECT g.gene, array_join(array_sort(collect_set(g.ko)), ';') AS kos, array_join(array_sort(collect_set(p.pathway)), ';') AS pathways FROM gene_ko g LEFT JOIN (SELECT DISTINCT pathway FROM path_q WHERE q <= 5e-2) p ON p.pathway = g.pathway GROUP BY g.gene) k ON k.gene = m.gene
  WHERE NOT m.in_cluster""")
    out = ordered(rows, F.col("ratio").desc(), F.col("gene"))
    return out.select(F.col("r").alias("rank"), "gene", "ko", F.round("cai", 6).alias("cai"), F.round("ratio", 6).alias("ratio"), "pathways", (F.col("pathways") != "").alias("priority"))


spark_query("be16_inefficiency_ratio", inefficiency)
