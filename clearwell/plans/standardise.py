"""The zero-filling cleaner: keeps every row and fills unusable numbers with 0."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from clearwell.functions import numbers, text
from clearwell.operators import columns as cols, rows

# Raw names that are dropped, in exactly this spelling.
UNUSED_COLUMNS = (
    "Topic", "Data_Value_Unit", "Data_Value_Type", "Data_Value_Footnote_Symbol",
    "Data_Value_Footnote", "Sex", "Total", "StratificationID1", "StratificationCategoryId1",
)

# snake_case names of the number columns, and the final names of four others.
WHOLE_COLUMNS = ("year_start", "year_end", "sample_size")
FLOAT_COLUMNS = ("data_value", "data_value_alt", "low_confidence_limit", "high_confidence_limit")
FINAL_NAMES = {
    "age(years)": "age_range",
    "income": "income_range",
    "stratification1": "stratification_value",
    "race/_ethnicity": "race_ethnicity",
}


def standardise(
    df: DataFrame,
    metric: str = "data_value",
    upper: Iterable[str] = (),
    capitalized: Iterable[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Deduplicate, tidy text and names, make numbers of number columns.

    Copies are removed before the text is trimmed, so rows that differ in blanks only stay. Numbers
    that are absent or unusable become 0. ``upper`` and ``capitalized`` name raw columns whose case
    is to be normalised. The metric must hold at least one number before the fill.
    """
    tidy = rows.dedupe(df).transform(cols.strip_names).transform(cols.strip_text)
    tidy = tidy.withColumns(
        {c: text.upper_code(cols.col(c)) for c in upper if c in tidy.columns}
        | {c: text.capitalize(cols.col(c)) for c in capitalized if c in tidy.columns}
    )
    named = tidy.transform(cols.drop_present, UNUSED_COLUMNS).transform(cols.snake_names)
    # The guard reads the input as it came: neither the dedupe nor the fill can change its answer.
    rows.require_metric(_metric_numbers(df, metric), metric)
    return named.transform(cols.coerce, WHOLE_COLUMNS, FLOAT_COLUMNS, strict).transform(
        cols.rename_present, FINAL_NAMES
    )


def _metric_numbers(df: DataFrame, metric: str) -> DataFrame:
    named = cols.rename_with(df, lambda n: text.snake_name(n.strip()))
    if metric not in named.columns:
        return named
    number = numbers.parse_double(cols.col(metric), named.schema[metric].dataType)
    return named.select(number.alias(metric))
