"""Marketplace stock analytics on Spark DataFrames."""
