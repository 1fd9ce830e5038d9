"""Spark-first engine for entity enrichment over already captured web pages."""
