"""Queries over the driver's tables, with SQL for each."""
