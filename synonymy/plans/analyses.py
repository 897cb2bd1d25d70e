"""Whole analyses: named groups of queries, run over one folder of tables and written as tables.

From a shell: ``python -m synonymy.plans.analyses comparative --tables DIR --out DIR``.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from synonymy.operators import multivariate, stability, trees
from synonymy.plans import registry, relations

ANALYSES = {
    "usage": "ag01_codon_counts ag02_rscu_gene ag03_rscu_median ag04_codon_frequency ag05_rscu_pooled ag06_enc ag07_gc3",
    "tables": "ag10_12_set_tables ag13_relative_adaptiveness ag14_adaptation_weights ag15_optimal_codons ag16_cbi",
    "expression": "ag24_expression_scores ag23_expression_table st36_metric_correlation st37_range_check",
    "advanced": "mv01_coa_inertia mv01_coa_genes mv01_coa_codons mv03_rscu_distance mv04_enc_diff ag08_gc12_gc3 ag09_pr2 st10_delta_rscu sf06_trna_wobble st13_trna_by_class st09_fisher st11_length_bias",
    "pairs": "ag17_codon_pairs ag18_cps ag19_gene_cpb ag21_bridge_bias ag22_pair_summary st15_cpb_by_tier",
    "ecology": "mv05_foreign_genes be01_growth_rate rs09_growth_interval be02_optimal_codons wn04_quintiles wn05_positional_fop be03_mobile_elements be04_strand_adjusted rs08_operon_null be06_divergence_islands",
    "cluster": "mv12_cluster_genes ag25_cluster_rscu mv15_membership_stability mv15_stability_metrics mv08_robust_reference rs13_bagged_reference rs14_subcluster_stability wn13_gap_boundary mv10_reference_mixtures mv09_dense_core mv11_density_peaks mv14_dual_anchor mv13_selection_votes",
    "optimization": "co01_three_way_table co02_optimization_summary co03_top_line co04_recommendation ag31_three_way_cai co05_gene_gain co01_cluster_table co02_cluster_summary co03_cluster_top_line co04_cluster_recommendation ag31_cluster_cai co05_cluster_gain",
    "gene_set": "gs02_goi_summary gs03_partition st27_scalar_tests st27_ks_two_sample st28_codon_references rs05_aitchison_permutation rs06_matched_permutation st29_partition_enrichment rs07_membership_permutation st26_tier_breakdown wn09_percentile_rank mv23_goi_clusters mv23_goi_ward st31_goi_drivers gs03_cluster_partition st29_cluster_enrichment rs06_foreign_permutation rs07_cluster_permutation",
    "enrichment": "st08_tier_enrichment st07_hypergeometric rs11_preranked_gsea be14_sample_gsea jn05_score_matrix st32_nes_between_conditions st20_pathways_between be16_inefficiency_ratio",
    "signatures": "sg01_gene_signature sg02_genome_signature",
    "corpus": "mv20_sample_clusters mv20_sample_density mv21_gene_clusters mv21_gene_density mv22_category_density mv26_clustermap_order st30_cluster_drivers fg18_cluster_profiles st33_mantel_test st34_contingency mv27_similarity_network",
    "comparative": "cm01_sample_metrics cm02_sample_table cm03_sample_medians ag33_within_condition ag34_rscu_dispersion st16_between_conditions st17_effect_summary st18_rscu_fold_change st25_permanova st19_class_rscu_between st21_strand_patterns st22_optimal_codons_between st23_foreign_burden st24_gc3_gc12",
}
ANALYSES = {name: queries.split() for name, queries in ANALYSES.items()}


#: Options of the command line: the parameter that each sets, and how its text is read.
PARAMETERS = {
    "resamples": (stability, "REPLICATES", int), "bagged-resamples": (stability, "BAGGED", int), "split-resamples": (stability, "SPLITS", int), "core-threshold": (stability, "CORE", float),
    "rescue-margin": (stability, "MARGIN", float), "rescue-reach": (stability, "REACH", float), "covered": (multivariate, "COVERED", float), "least-category": (trees, "LEAST_CATEGORY", int), "map-samples": (trees, "MAP_ROWS", int),
}


def tables(spark: SparkSession, sf_dir: str, analysis: str) -> Iterator[tuple[str, DataFrame]]:
    """(query, table) of an analysis, or of a single query."""
    for name in ANALYSES.get(analysis, [analysis]):
        yield name, registry.QUERIES[name](spark, sf_dir)


def write(spark: SparkSession, sf_dir: str, analysis: str, out: str, kind: str = "parquet") -> list[str]:
    """Write each table below ``out`` (parquet, or tsv with a header); the paths."""
    paths = []
    for name, df in tables(spark, sf_dir, analysis):
        paths.append(f"{out.rstrip('/')}/{name}")
        writer = df.write.mode("overwrite")
        writer.option("header", True).option("sep", "\t").csv(paths[-1]) if kind == "tsv" else writer.parquet(paths[-1])
    return paths


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="synonymy", description="Codon-usage analyses over a folder of tables")
    p.add_argument("analysis", choices=[*ANALYSES, *registry.QUERIES], metavar="analysis", help=", ".join(ANALYSES) + ", or one query")
    p.add_argument("--tables", required=True, help="folder of documents.parquet, labels.parquet and the others")
    p.add_argument("--out", required=True)
    p.add_argument("--format", choices=("parquet", "tsv"), default="parquet")
    for name, (module, parameter, kind) in PARAMETERS.items():
        p.add_argument(f"--{name}", type=kind, default=getattr(module, parameter))
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    o = options(argv)
    for name, (module, parameter, _) in PARAMETERS.items():
        setattr(module, parameter, getattr(o, name.replace("-", "_")))
    spark = SparkSession.builder.appName(f"synonymy {o.analysis}").getOrCreate()
    for path in write(spark, o.tables, o.analysis, o.out, o.format):
        print(path)
    relations.clear(spark)


if __name__ == "__main__":
    main()
