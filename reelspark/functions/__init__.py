"""Column functions: in columns, out a column; no joins, no grouping."""
