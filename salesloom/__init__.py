"""Wholesale-sales analytics as Spark jobs: ingest, operators, ten answers."""
