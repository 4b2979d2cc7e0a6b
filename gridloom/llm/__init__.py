"""Training-data operators: decontamination, deduplication, scoring, mixing and scans.

Nothing else in the library imports this subpackage.
"""
