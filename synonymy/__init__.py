"""Codon-usage analytics on Spark."""
