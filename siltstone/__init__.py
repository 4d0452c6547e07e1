"""Exploration, sketching and clustering of large tables on Spark DataFrames."""
