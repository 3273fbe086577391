"""Spark jobs that take a labelled table from raw rows to scored risk."""
