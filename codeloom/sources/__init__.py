"""Inputs and outputs: parquet tables, sheet-like text files, sinks, fixture views."""
