"""Warehouse sync and forecast analytics on Spark DataFrames."""
