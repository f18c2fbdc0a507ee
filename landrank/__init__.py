"""Ranking of large sets of partially measured records with PySpark."""
