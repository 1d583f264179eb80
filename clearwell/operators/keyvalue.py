"""Items for a key-value store: one JSON object per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clearwell.operators.columns import col
from clearwell.operators.ranking import number_rows
from clearwell.operators.rows import drop_missing

# Fixed value: the most items a store takes in one request.
BATCH_ITEMS = 25


def attribute(field: T.StructField) -> Column:
    """Value of one item attribute: dates as text, NaN and the text ``nan`` left out."""
    value = col(field.name)
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("string")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(field.dataType, T.StringType):
        return F.when(value != "nan", value)
    return value


def items(
    df: DataFrame, keys: Sequence[str], whole: Sequence[str] = (), item: str = "item"
) -> DataFrame:
    """Rows that have all keys, with the item as JSON; ``whole`` columns are cast to integer first.

    NULL attributes are left out of the JSON. Numbers keep their shortest text, so a reader that
    parses them as decimals gets the value that the text of the float has.
    """
    keyed = drop_missing(df, keys)
    keyed = keyed.withColumns({c: col(c).cast("int") for c in whole})
    attributes = [attribute(f).alias(f.name) for f in keyed.schema]
    return keyed.withColumn(item, F.to_json(F.struct(*attributes)))


def batch_numbers(
    df: DataFrame, order: Sequence[str], size: int = BATCH_ITEMS, name: str = "batch_no"
) -> DataFrame:
    """Number consecutive batches of ``size`` rows from 0, without one task seeing all rows.

    ``order`` names the key of the items, so no item repeats. Only keys are ranged and staged to be numbered; the
    numbers then meet their items by key, so an item is moved once and never written in between.
    For reports on batches of a stated order; the writer cuts its own batches and needs no numbers.
    """
    keys = df.select(*[col(c) for c in order])
    numbered = number_rows(keys, [], [col(c).asc_nulls_last() for c in order], name, distinct=True)
    numbered = numbered.withColumn(name, F.floor((col(name) - 1) / size))
    same = [df[f"`{c}`"].eqNullSafe(numbered[f"`{c}`"]) for c in order]
    return df.join(numbered, same).select(*[df[f"`{c}`"] for c in df.columns], numbered[name])
