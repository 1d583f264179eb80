"""Row numbers and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from clearwell.operators.columns import col
from clearwell.session import stage

_SLICE, _PLACE, _COPIES = "__slice", "__place", "__copies"

# Copies of a row are written out again in portions of this size, which are spread over the tasks.
PORTION_ROWS = 10_000
# A table of group starts is sent to every executor if it measures no more than this.
BROADCAST_BYTES = 64 * 1024 * 1024


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str,
    distinct: bool = False,
) -> DataFrame:
    """Number the rows of every group from 1 in the given order.

    A window partitioned by the group would send a whole group to one task. Instead the rows are
    range partitioned by group and order, so a large group spans many tasks. Every row notes its slice and its place in the slice, and is written out: from then on these are
    data, and a retried task or a lost executor cannot change them. A group starts in a slice at a
    place found by a small aggregate, and the rows it had in earlier slices come from a window over
    that aggregate, which holds at most one row per slice and group.

    Rows that ``order`` leaves tied follow a hash of the row, so they too are numbered alike in every
    run and can be spread. Only copies of a whole row cannot be told apart by a range: they are
    merged and counted first, so that a range holds distinct rows, and written out again at the end, each with its
    number. ``distinct`` spares that where no row can have many copies.
    """
    order = [*order, *_row_hashes(df)]
    keys = [col(g) for g in group] + list(order)
    columns = [col(c) for c in df.columns]
    rows = df if distinct else df.groupBy(*columns).agg(F.count(F.lit(1)).alias(_COPIES))
    if distinct:
        rows = rows.withColumn(_COPIES, F.lit(1).cast("bigint"))
    seen = Observation()
    placed = stage(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .withColumn(_SLICE, F.shiftright(col(_PLACE), 33))
        .observe(seen, F.max(_COPIES).alias("most")),
        "placed-rows",
    )
    repeated = (seen.get["most"] or 1) > 1
    if repeated:
        # A slice goes to one task once more, to make room for the copies of the rows before.
        earlier = Window.partitionBy(_SLICE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
        room = F.coalesce(F.sum(col(_COPIES) - 1).over(earlier), F.lit(0))
        placed = stage(placed.withColumn(_PLACE, col(_PLACE) + room), "placed-copies")
    per_slice = placed.groupBy(_SLICE, *[col(g) for g in group]).agg(
        F.min(_PLACE).alias("__first"), F.sum(_COPIES).alias("__rows")
    )
    earlier_slices = (
        Window.partitionBy(*[col(g) for g in group])
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = stage(
        per_slice.select(
            _SLICE,
            *[col(g) for g in group],
            (F.coalesce(F.sum("__rows").over(earlier_slices), F.lit(0)) - col("__first") + 1).alias(
                "__shift"
            ),
        ),
        "group-starts",
    )
    if _bytes(starts, group) <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    same_group = [placed[_SLICE] == starts[_SLICE]]
    same_group += [placed[_quoted(g)].eqNullSafe(starts[_quoted(g)]) for g in group]
    numbered = placed.join(starts, same_group).select(
        *[placed[_quoted(c)] for c in df.columns],
        placed[_COPIES],
        (placed[_PLACE] + starts["__shift"]).cast("bigint").alias(name),
    )
    return (_with_copies(numbered, name) if repeated else numbered).drop(_COPIES)


def _with_copies(numbered: DataFrame, name: str) -> DataFrame:
    """Write the copies of every row out again, numbered from its own number on.

    They are written in portions that are spread over a fixed number of tasks, so no task writes all copies of
    a frequent row. The number is stated because adaptive execution would merge these tasks by the size of their input,
    which is small before the copies.
    """
    tasks = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    portions = F.sequence(F.lit(0).cast("bigint"), F.floor((col(_COPIES) - 1) / PORTION_ROWS))
    once, often = numbered.filter(col(_COPIES) == 1), numbered.filter(col(_COPIES) > 1)
    portioned = often.withColumn("__portion", F.explode(portions)).repartition(tasks, "__portion", name)
    first = col(name) + col("__portion") * PORTION_ROWS
    last = col(name) + F.least((col("__portion") + 1) * PORTION_ROWS, col(_COPIES)) - 1
    others = [col(c) for c in numbered.columns if c != name]
    return once.unionByName(portioned.select(*others, F.explode(F.sequence(first, last)).alias(name)))


def _bytes(starts: DataFrame, group: Sequence[str]) -> int:
    """Size of the start table: two numbers and the text of the group per row."""
    texts = [F.coalesce(F.octet_length(col(g).cast("string")), F.lit(0)) + 16 for g in group]
    per_row = sum(texts, F.lit(32))
    return starts.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _descending(df: DataFrame, value: str, ties: Sequence[str]) -> list[Column]:
    if not isinstance(df.schema[value].dataType, T.NumericType):
        raise TypeError(f"{value} must be numeric: as text, '9' would rank above '10'")
    return [col(value).desc_nulls_last()] + [col(t).asc_nulls_last() for t in ties]


def _row_hashes(df: DataFrame) -> list[Column]:
    """96 bits that tell different rows apart, short enough to be sampled for the slice bounds."""
    row = [col(c) for c in df.columns]
    return [F.xxhash64(*row).asc(), F.hash(*row).asc()]


def rank_by_value(
    df: DataFrame,
    group: str = "location_abbr",
    value: str = "data_value",
    ties: Sequence[str] = (),
    name: str = "row_num",
    distinct: bool = False,
) -> DataFrame:
    """Row number by descending value within each group.

    Ties follow the columns in ``ties``, which should be short, and then a hash of the row, so the
    order of what is still tied is arbitrary but the same in every run.
    """
    return number_rows(df, [group], _descending(df, value, ties), name, distinct)


def top_k(
    df: DataFrame,
    k: int,
    group: str = "location_abbr",
    value: str = "data_value",
    ties: Sequence[str] = (),
    name: str = "row_num",
) -> DataFrame:
    """The k highest values of each group.

    The filter on the row number lets every task keep k rows per group before the shuffle, so the
    plain window is safe for groups of any size.
    """
    order = [*_descending(df, value, ties), *_row_hashes(df)]
    ranking = Window.partitionBy(col(group)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ranking).cast("bigint")).filter(col(name) <= k)
