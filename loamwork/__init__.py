"""Loamwork: corpus curation and evaluation on Spark DataFrames."""
