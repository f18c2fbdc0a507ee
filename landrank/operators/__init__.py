"""Operators: each takes DataFrames and returns one."""
