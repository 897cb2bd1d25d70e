"""Queries by name, with the SQL that other engines run."""

from __future__ import annotations

from synonymy.operators import clusters, comparisons, density, enrichment, genomics, multivariate, pairs, ranking, resampling, stability, statistics, trees, usage  # noqa: F401  they define the queries
from synonymy.plans import relations

QUERIES = relations.queries()
SQL = {name: relations.reference_sql(name) for name in relations.QUERIES if name not in relations.NO_SQL}
