"""Layered purchase analytics on Spark: reconcile, merge, roll up, publish."""
