"""Logical plans of the warehouse: each function maps DataFrames to a DataFrame."""
