"""Vulnerability-intelligence tables, search and summaries on Spark DataFrames."""
