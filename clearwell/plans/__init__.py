"""Whole pipelines and the datasets they are set up for."""
