"""Compositions: fits, diurnal transform, budgets, diagnostics, checks, lineage."""
