"""Exact and near-duplicate detection for large media and document catalogs, as Spark jobs."""
