"""Tabular data quality, synthetic-data release checks and report corpora on Spark."""
