"""Tramline: mobility and points-of-interest analytics on PySpark DataFrames."""
