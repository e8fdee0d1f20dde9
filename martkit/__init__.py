"""Warehouse loading and mart operators on Spark DataFrames."""
