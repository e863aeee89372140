"""Reading and writing: CSV landing, layer tables, report files and the adapter over the given tables."""
