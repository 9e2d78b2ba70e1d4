"""Continuous ingestion: files as streams, work that is left, and stages that wait for each other."""
