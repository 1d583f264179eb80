"""Cleaning, curating and validating tabular datasets with Spark DataFrames."""
