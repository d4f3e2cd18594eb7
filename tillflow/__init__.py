"""Incremental retail sales pipeline and sales analytics on open-source Spark."""
