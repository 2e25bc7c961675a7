"""Incremental runs of the same jobs over newly landed files."""
