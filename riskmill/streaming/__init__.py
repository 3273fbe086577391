"""Scoring of streams."""
