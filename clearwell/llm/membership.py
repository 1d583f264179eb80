"""Rows with and without certain keys, when rows are wide and keys are many.

A bitmap of hashed keys has some bits for each counted key, but 32 MB at most, and so may be broadcast. It settles
most rows where they are; only those whose bit is set, true members and a few others, are shuffled for the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEWEST_BITS, MOST_BITS = 18, 28
_PER_ROW = 1 << 15


def _bits(keys: int) -> int:
    """Logarithm of the size of the bitmap, at least 16 bits a key as long as the bound allows."""
    return min(MOST_BITS, max(FEWEST_BITS, (16 * keys).bit_length()))


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def _marked(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``row`` and ``likely``: whether the bit of the row's key is set."""
    bits = _bits(ids.count())
    maps = ids.select(_bit(F.col(ids.columns[0]).cast("long"), bits).alias("bit"))
    maps = maps.groupBy((F.col("bit") / _PER_ROW).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % _PER_ROW).alias("bits")
    )
    bit = _bit(F.col(key).cast("long"), bits)
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key).alias("key"),
        (bit / _PER_ROW).cast("int").alias("bucket"), (bit % _PER_ROW).cast("int").alias("place"),
    )
    byte = F.conv(F.hex(F.substring("bits", F.expr("place div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    joined = rows.join(F.broadcast(maps), "bucket", "left").withColumn("byte", byte)  # 2**MOST_BITS bits at most
    likely = F.expr("key IS NOT NULL AND (shiftright(byte, place % 8) & 1) = 1")
    return joined.select("row", "key", F.coalesce(likely, F.lit(False)).alias("likely"))


def likely_members(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a key in the first column of ``ids``, all that have one among them, and the other rows.

    Nothing is shuffled; for joins that settle the rest themselves.
    """
    marked = _marked(df, key, ids)
    return marked.where("likely").select("row.*"), marked.where("NOT likely").select("row.*")


def members(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in the first column of ``ids``; a NULL key is in none."""
    known = ids.select(F.col(ids.columns[0]).alias("key"))
    return _marked(df, key, ids).where("likely").join(known, "key", "left_semi").select("row.*")


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is not in the first column of ``ids``, those with a NULL key included."""
    known = ids.select(F.col(ids.columns[0]).alias("key"))
    marked = _marked(df, key, ids)
    kept = marked.where("likely").join(known, "key", "left_anti").select("row")
    return marked.where("NOT likely").select("row").unionByName(kept).select("row.*")
