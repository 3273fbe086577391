"""Readers, writers, fingerprints and saved artefacts."""
