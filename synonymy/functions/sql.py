"""Sequence functions for SQL: one call registers them, and their bodies are SQL that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name -> (parameters, result, body). Scalar bodies are expressions, table bodies queries.
FUNCTIONS = {
    "rna": ("seq STRING", "STRING", "translate(upper(seq), 'T', 'U')"),
    "revcomp": ("seq STRING", "STRING", "reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))"),
    "codons_of": ("seq STRING", "ARRAY<STRING>", "regexp_extract_all(translate(upper(seq), 'T', 'U'), '([A-Z]{3})', 1)"),
    "gc_share": ("seq STRING", "DOUBLE", "length(regexp_replace(seq, '[^GCgc]', '')) / nullif(CAST(length(seq) AS DOUBLE), 0)"),
    "gc3_share": ("seq STRING", "DOUBLE", "aggregate(regexp_extract_all(upper(seq), '([A-Z]{3})', 1), 0e0, (a, c) -> a + IF(substr(c, 3, 1) IN ('G', 'C'), 1e0, 0e0)) / nullif(CAST(floor(length(seq) / 3) AS DOUBLE), 0)"),
    "wright_enc": ("gc3 DOUBLE", "DOUBLE", "2e0 + gc3 + 29e0 / (gc3 * gc3 + (1 - gc3) * (1 - gc3))"),
    "effect_label": ("delta DOUBLE", "STRING", "CASE WHEN delta IS NULL THEN NULL WHEN delta < 0.147e0 THEN 'negligible' WHEN delta < 0.33e0 THEN 'small' WHEN delta < 0.474e0 THEN 'medium' ELSE 'large' END"),
    "codon_positions": ("seq STRING", "TABLE(pos BIGINT, codon STRING)", "SELECT CAST(p + 1 AS BIGINT) AS pos, c AS codon FROM (SELECT posexplode(regexp_extract_all(translate(upper(seq), 'T', 'U'), '([A-Z]{3})', 1)) AS (p, c))"),
    "codon_counts": ("seq STRING", "TABLE(codon STRING, n BIGINT)", "SELECT c AS codon, count(*) AS n FROM (SELECT explode(regexp_extract_all(translate(upper(seq), 'T', 'U'), '([A-Z]{3})', 1)) AS c) GROUP BY c"),
}


def register(spark: SparkSession) -> list[str]:
    """Define all functions in the session; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
