"""Relational operators over long tables: series, windows, joins, sets."""
