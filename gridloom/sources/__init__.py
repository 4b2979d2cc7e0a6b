"""Readers and writers. Parquet is canonical; text formats are parsed with built-in functions."""
