"""Continuous ingest with the column functions of the batch operators."""
