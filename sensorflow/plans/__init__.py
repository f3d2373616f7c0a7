"""Named queries over the given tables and their DuckDB twins."""
