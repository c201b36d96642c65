"""Composite operators: DataFrame → DataFrame functions built from Spark's own
operators.  Each runs distributed; only the caller decides to collect."""
