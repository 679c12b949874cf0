"""Batch operators over event DataFrames."""
