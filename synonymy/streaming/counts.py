"""Live codon usage: counts are sums, so a stream of new sequences keeps them current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.functions.codons import codon_dim
from synonymy.sources.tables import cds_from_documents, codon_positions


def codon_counts(documents: DataFrame) -> DataFrame:
    """sample_id, codon, n; run it on a stream in update or complete mode, or on a table."""
    cds = cds_from_documents(documents)
    return codon_positions(cds, "sample_id").join(F.broadcast(codon_dim(documents.sparkSession)), "codon").groupBy("sample_id", "codon").agg(F.count("*").alias("n"))  # 64 rows
