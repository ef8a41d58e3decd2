"""The library's operators bound to the benchmark tables, with their oracle."""
