"""Whole plans: rule compilation, derivation of points, the query catalogue."""
