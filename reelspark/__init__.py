"""Spark-first curation engine for web-video training data."""
