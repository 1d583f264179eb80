"""Text expressions: trimming, case, names and null tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Every character Python's str.strip removes, which is more than the blank SQL TRIM removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# The patterns that define the snake_case form, applied in this order, each with its
# replacement for Python and for the JVM.
SNAKE_PATTERNS = (
    (r"(.)([A-Z][a-z]+)", r"\1_\2", "$1_$2"),
    (r"([a-z0-9])([A-Z])", r"\1_\2", "$1_$2"),
    (r"[ -]", "_", "_"),
    (r"__+", "_", "_"),
)

# The texts pandas reads as missing by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def snake_name(name: str) -> str:
    """snake_case form of one column name, on the driver."""
    for pattern, replacement, _ in SNAKE_PATTERNS:
        name = re.sub(pattern, replacement, name)
    return name.lower().strip("_")


def snake_text(c: Column) -> Column:
    """snake_case form of the values of a text column."""
    for pattern, _, replacement in SNAKE_PATTERNS:
        c = F.regexp_replace(c, pattern, replacement)
    return F.btrim(F.lower(c), F.lit("_"))


def trim_blanks(c: Column) -> Column:
    """Remove leading and trailing blanks only; tabs and line breaks stay."""
    return F.trim(c)


def strip_whitespace(c: Column) -> Column:
    """Remove all leading and trailing white space, tabs and line breaks included."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper_code(c: Column) -> Column:
    return F.upper(strip_whitespace(c))


def capitalize(c: Column) -> Column:
    """First letter upper, all others lower; ``initcap`` would raise every word."""
    stripped = strip_whitespace(c)
    return F.concat(F.upper(F.left(stripped, F.lit(1))), F.lower(F.substr(stripped, F.lit(2))))


def null_if_token(c: Column, tokens: tuple[str, ...] = PANDAS_NULL_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def equality_key(c: Column) -> Column:
    """A text that is equal for equal texts and different for different ones, but never long.

    Texts over 64 bytes are represented by their SHA-256 digest and length, which is longer than
    that, so the two forms cannot meet. Shuffling keys of this kind costs the same for codes and for
    documents.
    """
    size = F.octet_length(c)
    digest = F.concat(F.sha2(c, 256), F.lit(":"), size.cast("string"))
    return F.when(size > 64, digest).otherwise(c)
