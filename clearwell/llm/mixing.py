"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Everything is DataFrame built-ins. Only one narrow row per document (source, size, draw) is staged;
texts are read once to size them and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import has, word_count
from clearwell.session import stage

#: A draw has 24 bits, told apart in two rounds of 12.
DRAW_BITS, ROUND_BITS = 24, 12


def draw(key: Column, text: Column, seed: int, place: Column | None = None) -> Column:
    """A number below 2**24 that depends on the key, the text and the seed; NULL counts as empty.

    ``place`` tells rows apart that are equal in both.
    """
    parts = [F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))]
    parts += [place.cast("string")] if place is not None else []
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, DRAW_BITS // 4), 16, 10).cast("int")


def cyclic_weights(totals: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """``(source, total)`` with a ``weight`` from the cycle, by code point of the source, NULL last.

    The window has one row per source and no text.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return totals.withColumn("weight", F.element_at(weights, (place - 1) % len(cycle) + 1))


def water_fill(totals: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Targets of ``(source, total, weight)``: ``share`` of all sizes, dealt out by weight.

    A source whose target would be above ``max_epochs`` times its total is clamped to that; what it
    leaves goes to the others by weight, which may clamp more of them. In the order of cap per weight the
    clamped sources come first, so running sums give the level at which the rest stands. A weight that
    is NULL or not positive gives the target 0. The window has one row per source.
    """
    usable = F.coalesce(F.col("weight") > 0, F.lit(False))
    cap = F.when(usable, F.col("total") * F.lit(float(max_epochs))).otherwise(F.lit(0.0))
    weight = F.when(usable, F.col("weight").cast("double")).otherwise(F.lit(0.0))
    everything = Window.partitionBy()
    order = [(F.col("cap") / F.nullif("w", F.lit(0.0))).asc_nulls_first(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.least(F.sum("total").over(everything) * F.lit(float(share)), F.sum("cap").over(everything))
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.nullif(F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)), F.lit(0.0))
    return (
        totals.withColumns({"cap": cap, "w": weight})
        .withColumn("level", level)
        .withColumn("clamped", F.coalesce(F.col("level") * F.col("w") >= F.col("cap"), F.lit(True)))
        .withColumn("level", F.max(F.expr("CASE WHEN NOT clamped THEN level END")).over(everything))
        .withColumn("target", F.when(F.col("clamped"), F.col("cap")).otherwise(F.col("level") * F.col("w")))
        .select("source", "total", "target")
    )


def _nearest_cut(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source the draw up to which documents are taken once more.

    The words still to take are counted off in the order of the draws: first in bins by the upper
    bits, then, inside the one bin where the target is reached, by whole draws. No window or group holds
    more than 2**12 rows of one source besides that last bin's.
    """
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    upper = F.shiftright("draw", DRAW_BITS - ROUND_BITS)
    by_source = Window.partitionBy("source")
    running = by_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)

    wanted = targets.where("rest > 0").select("source", "rest")
    bins = sized.groupBy("source", upper.alias("bin")).agg(F.sum("size").alias("words"))
    reached = (
        bins.withColumn("upto", F.sum("words").over(running))
        .alias("s").join(wanted.alias("t"), same)
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
        .select("t.source", "rest", "bin", (F.col("upto") - F.col("words")).alias("before"))
    )
    reached = stage(reached, "mix-bins")
    single = (
        sized.withColumn("bin", upper).alias("s")
        .join(reached.alias("t"), same & (F.col("s.bin") == F.col("t.bin")))
        .groupBy("t.source", "t.rest", "t.before", "s.draw").agg(F.sum("size").alias("words"))
    )
    steps = by_source.orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    options = single.select(
        "source", "rest", F.col("draw").alias("cut"), (F.col("before") + F.sum("words").over(steps)).alias("words")
    ).unionByName(
        reached.select(
            "source", "rest", (F.shiftleft("bin", DRAW_BITS - ROUND_BITS) - 1).alias("cut"),
            F.col("before").alias("words"),
        )
    )
    off = F.struct(F.abs(F.col("words") - F.col("rest")).alias("off"), F.col("cut"))
    return options.groupBy("source").agg(F.min(off)["cut"].alias("cut"))


def plan_mix(sized: DataFrame, weights=cyclic_weights, cycle=(3, 1, 2), share=1.5, max_epochs=2.0) -> DataFrame:
    """Targets and draws of a mix of ``sized`` = ``(source, size, draw)`` rows.

    Returns one row per source: ``source, total, target, whole`` (copies that every document gets) and
    ``cut`` (documents with a draw up to it get one copy more; -1: none). ``weights`` is a function of
    ``(totals, cycle)`` that adds a ``weight`` column.

    A NULL source is a source of its own. An empty table gives no row. Sources without words have the
    target 0. Rows that share a draw are taken together, so a source is met to within half of the words
    of one draw; rows that repeat or have no key have draws of their own.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("total"))
    targets = water_fill(weights(totals, cycle), share, max_epochs)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("total", F.lit(0))), F.lit(0)).cast("long")
    targets = targets.withColumn("whole", whole)
    targets = stage(
        targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("total")), "mix-targets"
    )
    cuts = _nearest_cut(sized, targets)
    same = F.col("t.source").eqNullSafe(F.col("c.source"))
    found = targets.alias("t").join(cuts.alias("c"), same, "left")
    return stage(
        found.select("t.source", "total", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")), "mix-plan"
    )


def sized_documents(documents: DataFrame, seed: int, key="doc_id", text="text", source="source") -> DataFrame:
    """``key, source, size, draw`` of every document, staged."""
    has(documents, key=key, text=text, source=source)
    return _sized(documents, seed, key, text, source)[0]


def _sized(documents: DataFrame, seed: int, key: str, text: str, source: str) -> tuple[DataFrame, DataFrame | None]:
    """Sized documents, and the draws that several rows share, if there are any.

    Rows that share key and text share their draw; each gets a draw of its own by its place in the table.
    """
    place = F.monotonically_increasing_id()
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"))
    sized = stage(
        rows.select(
            "key", "source", word_count(F.col("text")).alias("size"),
            draw(F.col("key"), F.col("text"), seed).alias("draw"),
            draw(F.col("key"), F.col("text"), seed, place).alias("own"), _same(F.col("key"), F.col("text")).alias("same"),
        ),
        "mix-sizes",
    )
    repeated = stage(sized.groupBy("same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("same"), "mix-repeated")
    if repeated.isEmpty():
        return sized.select("key", "source", "size", "draw"), None
    return stage(_own_draws(sized, repeated).select("key", "source", "size", "draw"), "mix-sizes"), repeated


def _same(key: Column, text: Column) -> Column:
    """Equal for rows that share key and text, and for hardly any others, which does no harm."""
    return F.xxhash64(key.cast("string"), key.isNull(), F.coalesce(text, F.lit("")))


def _own_draws(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with ``own`` as the draw of those that are ``repeated``."""
    marked = rows.join(repeated.withColumn("shared", F.lit(True)), "same", "left")
    return marked.withColumn("draw", F.when(F.col("shared"), F.col("own")).otherwise(F.col("draw"))).drop("shared")


def _copies(plan_alias: str = "t") -> Column:
    return F.col(f"{plan_alias}.whole") + (F.col("draw") <= F.col(f"{plan_alias}.cut")).cast("long")


def mixed_sizes(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per document its key, size, source's total and target, copies and words taken.

    The plan has one row per source; it is joined by its measured size, broadcast only if that is small.
    """
    joined = sized.alias("s").join(plan.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    return joined.select(
        "key", "s.source", "size", "total", "target", _copies().alias("copies"),
        (F.col("size") * _copies()).alias("taken"),
    )


def repeat_documents(documents: DataFrame, plan: DataFrame, seed: int, key="doc_id", text="text", source="source",
                     repeated: DataFrame | None = None) -> DataFrame:
    """The documents of the mix with the columns they came with; a row that is taken twice stands there twice.

    Empty documents are rows of no size and come as often as others of their draw. ``repeated`` names rows that share key
    and text, as :func:`mix_sources` finds them: each is drawn by itself.
    """
    has(documents, key=key, text=text, source=source)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(source).alias("source"),
        draw(F.col(key), F.col(text), seed).alias("draw"),
        *([] if repeated is None else [
            draw(F.col(key), F.col(text), seed, F.monotonically_increasing_id()).alias("own"),
            _same(F.col(key), F.col(text)).alias("same"),
        ]),
    )
    rows = rows if repeated is None else _own_draws(rows, repeated)
    joined = rows.alias("s").join(plan.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    taken = joined.select("row", _copies().cast("int").alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def mix_sources(documents: DataFrame, seed: int = 42, **plan) -> DataFrame:
    """Documents repeated so that their sources meet the target weights (see :func:`plan_mix`)."""
    sized, repeated = _sized(documents, seed, "doc_id", "text", "source")
    return repeat_documents(documents, plan_mix(sized.drop("key"), **plan), seed, repeated=repeated)
