"""Exact duplicates by skew-safe combining: in tasks, by salt, then over salts; all of it built-ins.

1. Every text is normalised and named by its SHA-256 digest. One narrow row per document is staged
   and counted by digest. Digests with more than a ``SHARE`` of all rows are hot; there can be no more than
   ``1 / SHARE`` of them, so their list may be broadcast.
2. Groups of ``(digest, salt, whole text)`` are merged inside each task and then over all tasks. The
   salt of a hot digest is drawn from the document's key, so the copies of one text meet in ``SALTS``
   places; all other digests have the one salt 0 and are complete here.
3. The winners of the salts of hot digests, at most ``SALTS / SHARE`` rows per different text, are combined.
4. Documents find the winner by digest and salt in narrow rows. A digest of several texts, should there ever be one,
   is settled by the texts themselves.

A text is shuffled once, and only if it is the first of its task; texts are compared whole in every step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.session import discard, stage

#: Above this share of all rows a digest is hot.
SHARE = 1e-4
#: Places in which the copies of one hot text meet.
SALTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case and every other letter as it is; NULL counts as empty.

    Where a text is ASCII ``lower`` does the same and is many times as fast.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _marked(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with ``hot``; the list of hot digests has at most ``1 / SHARE`` rows."""
    listed = F.broadcast(hot.withColumn("hot", F.lit(True)))
    return rows.join(listed, "digest", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def _salted(rows: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """``rows`` with ``hot`` and ``salt``: drawn from the key for hot digests, else 0."""
    drawn = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
    return _marked(rows, hot).withColumn("salt", F.when(F.col("hot"), drawn).otherwise(F.lit(0)))


def _merge(texts: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """``digest, keep, n`` of every different text of ``(key, digest, content)``; staged.

    Texts are part of the grouping key of both aggregates, so they are compared whole, not by digest.
    """
    # ``hot`` is an aggregate, so that the filters on it stay above the shuffle and both branches read one.
    local = _salted(texts, hot, salts).groupBy("digest", "salt", "content").agg(
        F.max("key").alias("keep"), F.count(F.lit(1)).alias("n"), F.max("hot").alias("hot")
    )
    over_salts = local.where("hot").groupBy("digest", "content").agg(
        F.max("keep").alias("keep"), F.sum("n").alias("n")
    )
    complete = local.where("NOT hot").select("digest", "keep", "n")
    return stage(complete.unionByName(over_salts.select("digest", "keep", "n")), "exact-texts")


def _by_content(documents: DataFrame, collided: DataFrame) -> DataFrame:
    """``row`` groups of documents whose digest several texts share, told apart by their texts."""
    texts = stage(documents.join(collided.select("digest"), "digest", "left_semi"), "exact-collided")
    newest = F.max(F.struct("key", "place"))
    groups = texts.groupBy("digest", "content").agg(newest.alias("top"), F.count(F.lit(1)).alias("group_size"))
    groups = stage(groups, "exact-groups")
    return texts.join(groups, ["digest", "content"]).select(
        "key", F.col("top.key").alias("keep"), "group_size",
        (F.col("place") == F.col("top.place")).alias("kept"), "digest",
    )


def exact_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text",
                     normalise: Callable[[Column], Column] = lower_ascii,
                     digest: Callable[[Column], Column] = sha256, share: float = SHARE,
                     salts: int = SALTS) -> DataFrame:
    """``key, keep_id, group_size, kept, digest`` of every row, dropped ones too.

    Texts are equal if they are after ``normalise``; NULL counts as the empty text. Of equal texts the row with
    the largest key stays: ``keep_id``. A NULL key is less than any other, and stays where all keys of the group are
    NULL. Where rows repeat with that same key exactly one of them is ``kept``. An empty table
    gives an empty result. Other columns are not read; keys may be of any type that can be ordered. ``digest``
    gives a binary; texts that it does not tell apart are still told apart.
    """
    has(documents, key=key, text=text)
    rows = documents.select(F.col(key).alias("key"), normalise(F.col(text)).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    narrow = stage(rows.select("key", "digest", F.monotonically_increasing_id().alias("place")), "exact-rows")
    # Of rows with the largest key one is named, by its place in the staged table.
    counts = stage(
        narrow.groupBy("digest").agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.struct("key", "place")).alias("top")
        ),
        "exact-counts",
    )
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = stage(counts.where(F.col("rows") > max(1.0, total * share)).select("digest"), "exact-hot")

    texts = _merge(rows, hot, salts)
    # A digest with one text has all rows of its digest in that text's group.
    single = texts.alias("t").join(counts.alias("c"), "digest").where(F.col("t.n") == F.col("c.rows"))
    winners = stage(
        _over_salts(single.select("digest", "t.keep", F.col("n").alias("group_size"), "c.top.place"), hot, salts),
        "exact-winners",
    )
    found = _salted(narrow, hot, salts).join(winners.withColumnRenamed("place", "best"), ["digest", "salt"])
    found = found.select("key", "keep", "group_size", (F.col("place") == F.col("best")).alias("kept"), "digest")
    collided = counts.join(winners, "digest", "left_anti")
    if not collided.isEmpty():
        placed = rows.withColumn("place", F.monotonically_increasing_id())
        found = found.unionByName(_by_content(placed, collided))
    discard(texts)
    return found.select(F.col("key").alias(key), F.col("keep").alias("keep_id"), "group_size", "kept", "digest")


def _over_salts(groups: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """``groups`` with ``salt``: a row for each salt of a hot digest, one of salt 0 for the others."""
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return _marked(groups, hot).withColumn("salt", F.explode(every)).drop("hot")


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text",
                normalise: Callable[[Column], Column] = lower_ascii,
                digest: Callable[[Column], Column] = sha256, **options) -> DataFrame:
    """The documents that :func:`exact_duplicates` keeps, with all their columns, whatever their names.

    Exactly one row of every different text stays, also where keys repeat or are NULL.
    """
    found = stage(exact_duplicates(documents, key, text, normalise, digest, **options), "exact-result")
    found = found.select(F.col(key).alias("key"), "keep_id", "kept", "digest")
    stays = F.col("key").eqNullSafe(F.col("keep_id"))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(key).alias("key"),
        normalise(F.col(text)).alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    same = F.col("r.digest").eqNullSafe(F.col("x.digest")) & F.col("r.key").eqNullSafe(F.col("x.key"))
    dropped = found.where(~stays).select("digest", "key").distinct()
    kept = rows.alias("r").join(dropped.alias("x"), same, "left_anti")
    repeated = stage(found.where(stays & ~F.col("kept")).select("digest", "key").distinct(), "exact-repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.alias("r").join(repeated.alias("x"), same, "left_semi").dropDuplicates(["key", "digest", "content"])
    return kept.alias("r").join(repeated.alias("x"), same, "left_anti").unionByName(once).select("row.*")
