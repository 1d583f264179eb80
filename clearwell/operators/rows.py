"""Operators that filter, replace or deduplicate rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from clearwell.functions.text import equality_key
from clearwell.operators.columns import col, on_text_columns


def exclude_codes(df: DataFrame, column: str, codes: Iterable[str]) -> DataFrame:
    """Drop rows with one of the codes; a row without a code goes too, as NOT IN is then unknown."""
    return df.filter(~col(column).isin(*codes))


def drop_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns.

    Plain predicates instead of ``dropna``: a scan skips row groups by them.
    """
    for name in columns:
        df = df.filter(col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(col(name)))
    return df


def require_metric(df: DataFrame, column: str) -> DataFrame:
    """Raise if the metric is absent or never filled; otherwise return ``df`` unchanged.

    Looks for one value and stops there; only a metric without any is read to the end.
    """
    if column not in df.columns or df.filter(col(column).isNotNull()).select(col(column)).isEmpty():
        raise ValueError(f"{column} is missing or entirely null")
    return df


def dedupe(df: DataFrame) -> DataFrame:
    """Distinct rows, with NULL equal to NULL.

    Copies are merged inside each task before the shuffle, so a row copied a billion times sends
    one row per task to its reducer.
    """
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: all rows, distinct rows and their difference, in one pass.

    Only keys are shuffled, so long texts travel as digests.
    """
    keys = on_text_columns(df, equality_key)
    copies = keys.groupBy(*[col(c) for c in keys.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    total = F.coalesce(F.sum("__copies"), F.lit(0))
    distinct = F.count(F.lit(1))
    return copies.agg(
        total.alias("n_rows"), distinct.alias("n_distinct"), (total - distinct).alias("n_duplicates")
    )


def replace_values(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """Replace exact matches, then trim blanks."""
    replaced = df.replace(dict(values), subset=[column])
    return replaced.withColumn(column, F.trim(col(column)))


def category_levels(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column."""
    return df.select(col(column).alias("level")).dropna().distinct()


def head_rows(df: DataFrame, order: Iterable[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows of a stated order; every task keeps ``n`` rows, nothing is shuffled."""
    return df.orderBy(*[col(c) for c in order]).limit(n)
