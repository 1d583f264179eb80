"""Operators on column names, column sets and whole-column conversions."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clearwell.functions import numbers, text


def col(name: str) -> Column:
    """Column by exact name, also for names such as ``Age(years)`` or ``a.b``."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_with(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename all columns at once; two columns may not end with the same name."""
    names = [rule(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"several columns would be named {clashes}")
    return df.toDF(*names)


def strip_names(df: DataFrame) -> DataFrame:
    return rename_with(df, str.strip)


def snake_names(df: DataFrame) -> DataFrame:
    return rename_with(df, text.snake_name)


def storable_names(df: DataFrame) -> DataFrame:
    """Names a table format accepts: blanks become ``_``, the characters ``( ) , ; =`` go."""
    return rename_with(df, lambda n: re.sub(r"[(),;=]", "", n.strip().replace(" ", "_")))


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by exact, case-sensitive name; absent names are ignored."""
    unwanted = set(names)
    return df.select(*[col(c) for c in df.columns if c not in unwanted])


def on_text_columns(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """Apply ``change`` to every string column in one projection."""
    return df.select(
        *[
            change(col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name)
            for f in df.schema
        ]
    )


def trim_text(df: DataFrame) -> DataFrame:
    return on_text_columns(df, text.trim_blanks)


def strip_text(df: DataFrame) -> DataFrame:
    return on_text_columns(df, text.strip_whitespace)


def pandas_nulls(df: DataFrame) -> DataFrame:
    """Null every text that pandas would have read as missing."""
    return on_text_columns(df, text.null_if_token)


def coerce(
    df: DataFrame, whole: Iterable[str] = (), floats: Iterable[str] = (), strict: bool = True
) -> DataFrame:
    """Turn the listed columns, where present, into bigint or 32-bit float with 0 for bad cells."""
    types = {f.name: f.dataType for f in df.schema}
    changed = {c: numbers.long_or_zero(col(c), types[c], strict) for c in whole if c in types}
    changed |= {c: numbers.float_or_zero(col(c), types[c]) for c in floats if c in types}
    return df.withColumns(changed)


def is_missing(df: DataFrame, name: str) -> Column:
    """Whether a value is missing: NULL, or NaN in a floating-point column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of non-null values of every column."""
    return df.agg(*[F.count(col(c)).alias(c) for c in df.columns])


def find_null_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold no value at all, from one aggregate over the input."""
    if not df.columns:
        return []
    counts = non_null_counts(df).first()
    return [c for c, n in zip(df.columns, counts) if n == 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all."""
    return drop_present(df, find_null_columns(df))


def with_interval_flag(df: DataFrame, low: str, high: str, name: str = "low_le_high") -> DataFrame:
    """Flag rows whose lower limit does not exceed the upper; an unknown limit counts as false."""
    return df.withColumn(name, F.coalesce(col(low) <= col(high), F.lit(False)))


def _require(df: DataFrame, schema: T.StructType) -> None:
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Select the declared columns in order and cast them.

    A cell that does not fit its type becomes NULL, or raises if ``strict``. NULL in a column declared NOT NULL
    and text longer than its VARCHAR raise while the rows are processed, so there is no checking job.
    """
    _require(df, schema)
    return df.select(*[_conformed(f, df.schema[f.name].dataType, strict) for f in schema])


def misfit_reasons(df: DataFrame, schema: T.StructType) -> Column:
    """Why a row does not fit the declared columns, one reason per cell; NULL for a row that fits."""
    _require(df, schema)
    reasons = []
    for f in schema:
        cell, source = col(f.name), df.schema[f.name].dataType
        if isinstance(f.dataType, T.VarcharType):
            too_long = F.length(cell.cast("string")) > f.dataType.length
            reasons.append(F.when(too_long, F.lit(f"{f.name}: text longer than {f.dataType.length}")))
        else:
            unfit = cell.isNotNull() & numbers.cast_or_null(cell, source, f.dataType).isNull()
            reasons.append(F.when(unfit, F.lit(f"{f.name}: no {f.dataType.simpleString()}")))
        if not f.nullable:
            reasons.append(F.when(cell.isNull(), F.lit(f"{f.name}: must not be null")))
    return F.nullif(F.concat_ws("; ", *reasons), F.lit(""))


def _conformed(field: T.StructField, source: T.DataType, strict: bool) -> Column:
    if isinstance(field.dataType, T.VarcharType):
        value = col(field.name).cast("string")
        limit = field.dataType.length
        too_long = F.raise_error(F.lit(f"{field.name}: text longer than {limit}"))
        value = F.when(F.length(value) > limit, too_long.cast("string")).otherwise(value)
    else:
        value = numbers.cast_or_null(col(field.name), source, field.dataType)
        if strict:
            kind = field.dataType.simpleString()
            unfit = F.raise_error(F.concat(F.lit(f"{field.name}: no {kind}: "), col(field.name).cast("string")))
            value = F.when(value.isNull() & col(field.name).isNotNull(), unfit.cast(field.dataType)).otherwise(value)
    if not field.nullable:
        absent = F.raise_error(F.lit(f"{field.name} must not be null"))
        value = F.coalesce(value, absent.cast(value_type(field.dataType)))
    return value.alias(field.name)


def value_type(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, T.VarcharType) else data_type
