"""Whole jobs composed from the operators: report, ingest, dry run, export."""
