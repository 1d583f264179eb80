"""Number expressions: coercion with a fill value, decimals and change ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

ITEM_DECIMAL = T.DecimalType(38, 18)
#: How the JVM shows a finite number: digits, digits after the point, exponent.
SHOWN_NUMBER = r"^(-?\d+)\.(\d+)(?:E(-?\d+))?$"

_DIGITS = r"(?:\d+\.?\d*|\.\d+)"
NUMBER_TEXT = rf"^\s*[+-]?(?:{_DIGITS}(?:[eE][+-]?\d{{1,2}})?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
LONG_EXPONENT_TEXT = rf"^\s*[+-]?{_DIGITS}[eE][+-]?\d{{3,}}\s*$"
WHOLE_TEXT = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"


def parse_double(c: Column, source: T.DataType = T.StringType()) -> Column:
    """Number in ``c``, NULL where there is none or it is NaN.

    Text is matched against the form of a number first. A failing cast costs an exception per cell
    inside the JVM, many times the price of the match, and the cast alone would also accept Java
    forms such as ``1d``, which pandas does not. Digits too large for a double are no number.
    """
    number = c.try_cast("double")
    if isinstance(source, T.StringType):
        finite = F.when(F.abs(number) < float("inf"), number)
        return F.when(c.rlike(NUMBER_TEXT), number).when(c.rlike(LONG_EXPONENT_TEXT), finite)
    return F.nanvl(number, F.lit(None).cast("double"))


def long_or_zero(
    c: Column, source: T.DataType = T.StringType(), strict: bool = True
) -> Column:
    """Whole number in ``c``, 0 where there is none.

    Text is read digit by digit, also in the form ``2011.0``, so numbers beyond 2^53 keep all their
    digits; only other forms, such as ``2e3``, go through a double. A fractional number or one out
    of range raises, as it does for a nullable integer column in pandas, unless ``strict`` is off:
    then it is truncated or becomes 0.

    The branches are few and each is short: generated code beyond 8000 bytes per method stays
    uncompiled in the JVM, and a table may have many such columns.
    """
    zero = F.lit(0).cast("bigint")
    if isinstance(source, T.IntegralType):
        return F.coalesce(c.cast("bigint"), zero)
    number = parse_double(c, source)
    if isinstance(source, T.StringType):
        number = c.try_cast("double")
    if strict:
        error = F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string")))
        rounded = F.when(F.rint(number) == number, number.cast("bigint"))
        rounded = rounded.otherwise(error.cast("bigint"))
    else:
        rounded = F.coalesce(number.try_cast("bigint"), zero)
    if not isinstance(source, T.StringType):
        return F.when(number.isNotNull(), rounded).otherwise(zero)
    digits = F.regexp_extract(c, WHOLE_TEXT, 1)
    digits = digits.cast("bigint") if strict else F.coalesce(digits.try_cast("bigint"), zero)
    return F.when(c.rlike(WHOLE_TEXT), digits).when(c.rlike(NUMBER_TEXT), rounded).otherwise(zero)


def cast_or_null(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast, with NULL for a value that does not fit; text that is no number is not even tried."""
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        return F.when(c.rlike(NUMBER_TEXT), c.try_cast(target))
    return c.try_cast(target)


def whole_number_or_raise(c: Column) -> Column:
    """Fill NULL with 0, then cast; text that is no whole number raises (ANSI cast)."""
    return F.coalesce(c, F.lit(0).cast("string")).cast("bigint")


def float_or_zero(c: Column, source: T.DataType = T.StringType()) -> Column:
    """Number in ``c`` as a 32-bit float, 0 where there is none."""
    return F.coalesce(parse_double(c, source).cast("float"), F.lit(0).cast("float"))


def on_floats(c: Column, data_type: T.DataType, change: Callable[[Column, T.DataType], Column]) -> Column:
    """Apply ``change`` to binary floats, also inside arrays, maps and structs; all else stays."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return change(c, data_type)
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda e: on_floats(e, data_type.elementType, change))
    if isinstance(data_type, T.MapType):
        return F.transform_values(c, lambda _, v: on_floats(v, data_type.valueType, change))
    if isinstance(data_type, T.StructType):
        fields = [on_floats(c.getField(f.name), f.dataType, change).alias(f.name) for f in data_type]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _digits_and_exponent(c: Column, data_type: T.DataType) -> Column:
    shown = c.cast("string")
    number = F.regexp_extract(shown, SHOWN_NUMBER, 0) != ""
    whole, fraction, exponent = (F.regexp_extract(shown, SHOWN_NUMBER, i) for i in (1, 2, 3))
    exponent = F.coalesce(F.nullif(exponent, F.lit("")).cast("int"), F.lit(0))
    digits = F.concat(whole, fraction)
    short = F.regexp_replace(digits, "0+$", "")
    exact = F.struct(
        F.nullif(F.nullif(short, F.lit("")), F.lit("-")).cast("bigint").alias("digits"),
        (exponent - F.length(fraction) + F.length(digits) - F.length(short)).alias("exponent"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("digits"), F.lit(0).alias("exponent"))
    return F.when(number, F.when(c == 0, zero).otherwise(exact))


def to_exact(c: Column, data_type: T.DataType) -> Column:
    """Binary floats as ``digits`` times ten to the ``exponent``, also inside arrays, maps and structs.

    These are the digits of the shortest text, without zeros at the end, so every finite number keeps its value
    whatever its size. NULL for NaN and infinity, which no decimal is.
    """
    return on_floats(c, data_type, _digits_and_exponent)


def to_decimal(c: Column, data_type: T.DataType) -> Column:
    """Binary floats as the decimal of their shortest text, also inside arrays, maps and structs.

    A number with digits beyond the 20 before and 18 after the point that the type has raises; :func:`to_exact` takes
    all numbers. NaN and infinity are NULL.
    """

    def exact(number: Column, kind: T.DataType) -> Column:
        value = number.cast("string").try_cast(ITEM_DECIMAL)
        finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
        lost = F.raise_error(F.concat(F.lit("more digits than a decimal holds: "), number.cast("string")))
        same = F.coalesce(value.cast(kind) == number, F.lit(False))
        return F.when(finite, F.when(same, value).otherwise(lost.cast(ITEM_DECIMAL)))

    return on_floats(c, data_type, exact)


def drop_ratio(previous: Column, current: Column) -> Column:
    """Share lost against the previous value; negative for growth, NULL against 0."""
    return F.try_divide(previous - current, previous)


def point_change(previous: Column, current: Column) -> Column:
    return current - previous
