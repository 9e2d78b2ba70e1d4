"""Queries: the operators applied to stand-in tables, each with the SQL that it must equal."""
