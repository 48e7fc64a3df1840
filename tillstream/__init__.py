"""Retail messages to keyed tables and search documents, on Spark DataFrames."""
