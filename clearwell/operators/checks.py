"""Data-quality checks: what each one counts and when it passes.

A check turns into two aggregate columns (rows that break it, an observed value) and a verdict on
their results, so that any number of checks over one table needs a single aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clearwell.functions.numbers import cast_or_null
from clearwell.operators.columns import col, is_missing
from clearwell.operators.rows import category_levels


@dataclass(frozen=True)
class Check:
    """Base of all checks. ``column`` is None for checks on the table as a whole."""

    column: str | None = None

    kind = ""
    needs_column = True

    def broken(self, df: DataFrame) -> Column | None:
        """Predicate that is true for a row breaking the check; None where rows do not matter."""
        return None

    def observed(self, df: DataFrame) -> Column:
        """Aggregate (or literal) reported as the observed value."""
        return F.lit(None).cast("double")

    def passes(self, observed: Column, unexpected: Column) -> Column:
        return unexpected == 0

    def considered(self, df: DataFrame) -> Column:
        """Aggregate with the number of rows the unexpected percentage refers to."""
        return F.count(F.lit(1)) if self.column is None else F.count(col(self.column))

    def applies_to(self, df: DataFrame) -> bool:
        return not self.needs_column or self.column in df.columns


@dataclass(frozen=True)
class RowCountBetween(Check):
    low: int = 0
    high: int = 0
    kind = "expect_table_row_count_to_be_between"
    needs_column = False

    def observed(self, df):
        return F.count(F.lit(1)).cast("double")

    def passes(self, observed, unexpected):
        return observed.between(self.low, self.high)


@dataclass(frozen=True)
class ColumnCount(Check):
    expected: int = 0
    kind = "expect_table_column_count_to_equal"
    needs_column = False

    def observed(self, df):
        return F.lit(float(len(df.columns)))

    def passes(self, observed, unexpected):
        return observed == self.expected


@dataclass(frozen=True)
class ColumnExists(Check):
    kind = "expect_column_to_exist"
    needs_column = False

    def observed(self, df):
        return F.lit(float(self.column in df.columns))

    def considered(self, df):
        return F.count(F.lit(1))

    def passes(self, observed, unexpected):
        return observed == 1


@dataclass(frozen=True)
class ValuesBetween(Check):
    """Values inside inclusive bounds, missing ones aside; an open end is None.

    Text that is no number is outside, as it cannot be compared.
    """

    low: float | None = None
    high: float | None = None
    kind = "expect_column_values_to_be_between"

    def broken(self, df):
        value = col(self.column)
        outside = F.lit(False)
        bounded = self.low is not None or self.high is not None
        if bounded and isinstance(df.schema[self.column].dataType, T.StringType):
            value = cast_or_null(value, T.StringType(), T.DoubleType())
            outside = value.isNull() | F.isnan(value)
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return outside & ~is_missing(df, self.column)


@dataclass(frozen=True)
class ValuesInSet(Check):
    allowed: Sequence = ()
    kind = "expect_column_values_to_be_in_set"

    def broken(self, df):
        return ~col(self.column).isin(*self.allowed)


@dataclass(frozen=True, eq=False)
class ValuesKnown(Check):
    """Values must be among the ``level`` rows of a table, such as the categories of a baseline batch.

    The runner looks them up in a join of their own, so the categories may be many and never come to the driver.
    """

    levels: DataFrame | None = None
    kind = "expect_column_values_to_be_in_set"


@dataclass(frozen=True)
class ValuesMatch(Check):
    pattern: str = ""
    kind = "expect_column_values_to_match_regex"

    def broken(self, df):
        return ~col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class ValuesNotNull(Check):
    """No value is NULL or NaN."""

    kind = "expect_column_values_to_not_be_null"

    def broken(self, df):
        return is_missing(df, self.column)

    def considered(self, df):
        return F.count(F.lit(1))


@dataclass(frozen=True)
class ValuesUnique(Check):
    """Every member of a group of equal values is unexpected; NULL is ignored.

    The runner counts these in a grouped aggregate of their own.
    """

    kind = "expect_column_values_to_be_unique"


@dataclass(frozen=True)
class TrueFlag(Check):
    """A boolean that must be true in every row."""

    kind = "expect_column_values_to_be_in_set"

    def broken(self, df):
        return ~col(self.column)


@dataclass(frozen=True)
class MissingCountZero(ValuesNotNull):
    kind = "missing_count"


@dataclass(frozen=True)
class InvalidCountZero(Check):
    """Non-null values must respect every rule given; an absent rule is None."""

    low: float | None = None
    high: float | None = None
    length: int | None = None
    kind = "invalid_count"

    def broken(self, df):
        value = col(self.column)
        invalid = ValuesBetween(self.column, self.low, self.high).broken(df)
        if self.length is not None:
            invalid = invalid | (F.length(value) != self.length)
        return invalid


@dataclass(frozen=True)
class RowCountRule(RowCountBetween):
    kind = "row_count"


@dataclass(frozen=True)
class NoFailedRows(Check):
    """No row may satisfy the SQL condition; ``column`` carries the name of the check."""

    condition: str = "false"
    kind = "failed_rows"
    needs_column = False

    def broken(self, df):
        return F.expr(self.condition)

    def considered(self, df):
        return F.count(F.lit(1))


def learn_categories(baseline: DataFrame, columns: Sequence[str]) -> list[Check]:
    """Checks that a later batch holds no category that the baseline batch does not have."""
    present = [c for c in columns if c in baseline.columns]
    return [ValuesKnown(c, category_levels(baseline, c)) for c in present]


def failed_rows(df: DataFrame, condition: str) -> DataFrame:
    """The rows that satisfy a fail condition."""
    return df.filter(F.expr(condition))


def learn_ranges(baseline: DataFrame, columns: Sequence[str]) -> list[Check]:
    """Between checks with the bounds of a baseline batch, to be run on a later one.

    One aggregate; only its single row of bounds comes to the driver.
    """
    present = [c for c in columns if c in baseline.columns]
    if not present:
        return []
    edges = [f(col(c)) for c in present for f in (F.min, F.max)]
    bounds = baseline.agg(*edges).first()
    return [ValuesBetween(c, bounds[2 * i], bounds[2 * i + 1]) for i, c in enumerate(present)]
