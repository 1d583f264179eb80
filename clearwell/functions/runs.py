"""Batch and run labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the layout of a run label, as in 20240131_235959.
RUN_LAYOUT = "yyyyMMdd_HHmmss"


def run_label(moment: Column) -> Column:
    return F.date_format(moment, RUN_LAYOUT)


def batch_name(file_path: Column) -> Column:
    """File name up to its first dot."""
    return F.regexp_extract(file_path, r"([^/.]*)[^/]*$", 1)
