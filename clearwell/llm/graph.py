"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.session import discard, stage


def _state(edges: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mark).first())


def _smallest(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every pair ``(a, b)`` with ``m``, the smallest of ``a`` and all that it is paired with; and the table of ``m``.

    The minima are written first, so that the join is one of plain tables and a node with very
    many pairs can be split among tasks.
    """
    least = stage(pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "component-minima")
    return pairs.join(least, "a"), least


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``(a, b)``: the smallest node reachable.

    Alternating large-star and small-star steps; each joins edges with the minimum of their
    neighbourhood, so no neighbourhood is gathered. Edges are written in every round.
    Rows with a NULL and loops are left out; an empty table gives an empty result.
    """
    known = edges.select("a", "b").dropna().where("a <> b")
    pairs = known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, "component-edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near, minima = _smallest(both)
        large = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "component-edges")
        discard(minima)
        discard(pairs)
        small, minima = _smallest(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        pairs = stage(small.where("a <> b").distinct(), "component-edges")
        discard(minima)
        discard(large)
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
