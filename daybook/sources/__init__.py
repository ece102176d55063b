"""Scans.  Each returns a lazy frame; row selection is left to Spark's pushdown."""
