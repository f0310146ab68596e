"""Spark jobs that build, search and evaluate text knowledge bases."""
