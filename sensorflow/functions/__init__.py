"""Column-level building blocks: guarded comparisons, limits per sensor type, parsing, text formats."""
