"""Lakehouse operators on plain Spark: sources, mutations, versions, change feed."""
