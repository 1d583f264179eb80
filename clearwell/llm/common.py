"""Expressions and small steps that several operators of this subpackage use."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and
#: carriage return. The pattern means the same to Java, Python and RE2.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words in a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def has(df: DataFrame, **names: str) -> None:
    """Raise if a named column is absent."""
    if absent := [f"{use}={name!r}" for use, name in names.items() if name not in df.columns]:
        raise ValueError(f"no such column: {', '.join(absent)}; there are {df.columns}")


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of this library on the import path of Python workers that can reach it.

    On a cluster that does not share the folder the library is submitted with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
