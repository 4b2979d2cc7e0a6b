"""Gridded flux analytics on Spark."""
