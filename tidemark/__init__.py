"""Tidemark: media-monitoring text analytics on Spark DataFrames."""
