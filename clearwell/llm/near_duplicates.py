"""Near-duplicates by bottom-k sketches, inverted lists and exact verification.

1. Every text becomes its set of word-shingle hashes; the ``k`` smallest are its sketch. Equal
   sets are merged, so each set is one node of the graph, named by its smallest document id.
2. Inverted lists of the retained values generate overlaps. Two sets at the threshold share, but for a chance of
   ``MISS``, a known number of retained values; so only the rarest values of a sketch have to be
   indexed for them to meet (prefix filter), and very common shingles make no lists. How rare a value is
   tells an array of counts of fixed size.
3. Every set has a home, its longest list by those counts; of equal ones the same for all. Homes are compared inside, very long ones by one
   member first, which joins most of a group of near copies at linear cost. What is left are lists
   whose members are still in different components: members outside the most frequent component are
   compared with all others that they meet in several lists, in blocks of bounded size.
4. A comparison estimates the similarity from the union of the sketches and drops what cannot
   reach the threshold; the texts of the rest are fetched and confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.llm.graph import components
from clearwell.llm.membership import likely_members, members, without
from clearwell.llm.shingles import set_digest, shingle_set
from clearwell.session import discard, small_batches, stage

#: Chance that one linked pair is lost by the sketches.
MISS = 1e-9
#: Cells in which retained values are counted, and how many of them go in one row.
CELL_BITS = 26
CHUNK_BITS = 16
#: Values that a task counts at a time.
CELLS_HELD = 4_000_000
#: Listed values that two sets at the threshold share, if they have so many; an odd number.
SHARED = 5
#: Rows of either side that are compared in one piece.
BLOCK_ROWS = 1024
#: Members of a list that are gathered in one place.
GATHERED = 64
#: Texts that a Python worker is sent at a time.
TEXTS = 1024


@lru_cache(maxsize=4096)
def least_overlap(sampled: int, percent: int) -> int:
    """Shared values that a sample of the union has, but for a chance of ``MISS``, at the threshold."""
    p, chance = percent / 100, 0.0
    for shared in range(sampled + 1):
        log = (
            math.lgamma(sampled + 1) - math.lgamma(shared + 1) - math.lgamma(sampled - shared + 1)
            + shared * math.log(p) + (sampled - shared) * math.log1p(-p)
        )
        chance += math.exp(log)
        if chance > MISS:
            return shared
    return sampled


def sketches(documents: DataFrame, key: str, text: str, width: int, k: int) -> DataFrame:
    """``key, n_shingles, digest, sketch`` of every document, whole texts."""
    schema = "key long, n_shingles long, digest binary, sketch array<long>"

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(1)]
            kept = [s[:k] for s in sets]
            ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            values = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(values)),
                ],
                names=["key", "n_shingles", "digest", "sketch"],
            )

    return documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        sketched, schema
    )


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts in four bits: 0 to 3 as they are, then in steps of 2 and, from 16 on, of 4."""
    exponent = np.frexp(np.maximum(counts, 1).astype(float))[1] - 1
    steps = np.where(counts < 16, exponent + 2, 4 + exponent // 2)
    return np.where(counts < 4, counts, np.minimum(steps, 15)).astype(np.uint8)


def _cells(values: np.ndarray) -> np.ndarray:
    return values & ((1 << CELL_BITS) - 1)


def count_levels(nodes: DataFrame) -> np.ndarray:
    """How often values of each cell are retained, as levels, two cells a byte.

    A value shares its cell with others, so its level is never too low. The array has a fixed size (32 MB): on
    large tables rare values look more frequent than they are, which makes more lists and loses none.
    Tasks send the cells they have met, about two bytes a value.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for last, batch in chain(((False, b) for b in batches), [(True, None)]):
            if not last:
                held.append(_cells(batch.column(0).flatten().to_numpy()).astype(np.uint32))
            size = sum(map(len, held))
            if size and (last or size >= CELLS_HELD):
                cells, counts = np.unique(np.concatenate(held), return_counts=True)
                held = []
                parts = cells >> CHUNK_BITS
                chunks, starts = np.unique(parts, return_index=True)
                places = (cells & ((1 << CHUNK_BITS) - 1)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chunks, pa.int32()),
                        pa.array([x.tobytes() for x in np.split(places, starts[1:])], pa.binary()),
                        pa.array([x.tobytes() for x in np.split(counts.astype(np.uint32), starts[1:])], pa.binary()),
                    ],
                    names=["chunk", "places", "counts"],
                )

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for chunk, parts in groupby(rows, key=lambda row: row[0]):
            total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
            for _, places, counts in parts:
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint32)
            levels = _level(total)
            yield pd.DataFrame({"chunk": [chunk], "levels": [(levels[::2] | levels[1::2] << 4).tobytes()]})

    met = nodes.select("sketch").mapInArrow(counted, "chunk int, places binary, counts binary")
    by_chunk = met.repartition("chunk").sortWithinPartitions("chunk")
    levels = np.zeros((1 << (CELL_BITS - CHUNK_BITS), 1 << (CHUNK_BITS - 1)), dtype=np.uint8)
    rows = by_chunk.mapInPandas(summed, "chunk int, levels binary").collect()  # 2**CELL_BITS cells of four bits at most
    for row in rows:
        levels[row["chunk"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels.ravel()


def index_entries(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """``value, node, n_shingles, home`` of the inverted lists.

    A sketch's values are ordered by the level of their cell, then by themselves. Of ``kept`` values, any partner
    at the threshold shares at least ``needed``, so in that or any other common order it shares one of the
    first ``kept - needed + 1``, the core, and ``SHARED`` (or ``needed``, if less) of the first
    ``kept - needed + SHARED``. Values that no other sketch has take their places in that order but make no list.
    The home is the value of the core with the highest level, hence of about the longest list; its row has
    ``value = home``. Of values at that level it is the smallest: a core ends at the largest ones, sooner in a set with more
    rare values of its own, so near copies differ in the largest value of their cores but seldom in the smallest. Sets without one are linked with nothing and have no rows.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(count_levels(nodes))
    least = least_overlap(k, percent)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, values = batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy()
            ends = np.asarray(batch.column(2).offsets).astype(np.int64)
            kept, starts = np.diff(ends), ends[:-1] - ends[0]
            cells = _cells(values)
            level = (shared.value[cells >> 1] >> (4 * (cells & 1)).astype(np.uint8)) & 15
            row = np.repeat(np.arange(len(sizes)), kept)
            order = np.argsort(row * 16 + level, kind="stable")  # values of a sketch are sorted
            needed = np.where(sizes * 100 <= k * percent, -(-sizes * percent // 100), least)
            beyond = np.arange(len(values)) - starts[row] - (kept - needed)[row]
            places = np.flatnonzero((beyond < SHARED) & (level[order] > 1))
            wanted, owner = order[places], row[places]
            core = beyond[places] < 1
            own, of = wanted[core], owner[core]
            ranked = np.lexsort((~values[own], level[own], of))
            own, of = own[ranked], of[ranked]
            last = np.flatnonzero(np.append(of[1:] != of[:-1], True)) if len(of) else np.zeros(0, np.int64)
            home, settled = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
            home[of[last]], settled[of[last]] = values[own[last]], True
            wanted, owner = wanted[settled[owner]], owner[settled[owner]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[wanted]), batch.column(0).take(pa.array(owner)), pa.array(sizes[owner]),
                    pa.array(home[owner]),
                ],
                names=["value", "node", "n_shingles", "home"],
            )

    return nodes.select("node", "n_shingles", "sketch").mapInArrow(
        listed, "value long, node long, n_shingles long, home long"
    )


def _meetings(n_shingles: Column, k: int, percent: int) -> Column:
    """In how many lists one of two linked sets is asked to meet the home of the other.

    They share ``SHARED`` listed values if both need so many. A list asks all but the members of its most frequent
    component, hence at least one of the two; so one of them is asked in more than half of those lists.
    """
    if least_overlap(k, percent) < SHARED:
        return F.lit(1)
    # A partner has at least percent of the shingles and needs percent of those.
    return F.when(n_shingles * percent**2 >= SHARED * 100**2, (SHARED + 1) // 2).otherwise(1)


@dataclass
class _Side:
    """Sketches of one side of a comparison, and the full sets once they are needed."""

    components: np.ndarray
    sizes: np.ndarray
    sketches: list[np.ndarray]
    sets: list[np.ndarray] | None
    k: int

    def __post_init__(self):
        top = np.iinfo(np.uint64).max
        self.kept = np.array([len(s) for s in self.sketches])
        self.matrix = np.full((len(self.sketches), self.k), top, dtype=np.uint64)
        for i, s in enumerate(self.sketches):
            self.matrix[i, : len(s)] = s
        # Up to its bound a sketch knows its whole set.
        self.bound = np.where(self.sizes <= self.k, top, self.matrix[:, -1])
        self.by_sketch = self._inverted(self.sketches)
        self.by_set = self._inverted(self.sets) if self.sets else None

    @staticmethod
    def _inverted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate(parts)
        owners = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(values, kind="stable")
        return values[order], owners[order]

    def shared(self, values: np.ndarray, inverted: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """How many of the values each set has."""
        flat, owners = inverted
        start, end = np.searchsorted(flat, values, "left"), np.searchsorted(flat, values, "right")
        length = end - start
        places = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
        return np.bincount(owners[places], minlength=len(self.sketches))


def _candidates(asked: _Side, others: _Side, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every set asked about, which others of other components may reach the threshold.

    Both sketches are complete up to the smaller of their bounds, so the values up to there are a sample of the union.
    """
    enough = np.array([least_overlap(m, percent) for m in range(2 * asked.k + 1)])
    for i, sketch in enumerate(asked.sketches):
        common = others.shared(sketch, others.by_sketch)
        bound = np.minimum(asked.bound[i], others.bound)
        own = np.searchsorted(sketch, bound, "right")
        theirs = np.minimum((others.matrix <= bound[:, None]).sum(axis=1), others.kept)
        n = asked.sizes[i]
        yield i, (
            (common >= enough[own + theirs - common])
            & (others.components != asked.components[i])
            & (np.minimum(n, others.sizes) * 100 >= np.maximum(n, others.sizes) * percent)
        )


def _linked(asked: _Side, others: _Side, percent: int) -> list[tuple[int, int]]:
    """Pairs of components that two sets at the threshold join, confirmed on the full sets.

    Sets that earlier pairs have joined are not compared again, so a group gives no more pairs than it has
    members.
    """
    found = set()
    one, two = asked.components.copy(), others.components.copy()
    for i, candidate in _candidates(asked, others, percent):
        candidate &= two != one[i]
        if not candidate.any():
            continue
        shared = others.shared(asked.sets[i], others.by_set)
        linked = np.flatnonzero(candidate & (shared * 100 >= (asked.sizes[i] + others.sizes - shared) * percent))
        labels, first = np.unique(two[linked], return_index=True)
        for label, j in zip(labels, linked[first], strict=True):
            a, b = int(asked.components[i]), int(others.components[j])
            found.add((max(a, b), min(a, b)))
            two[two == label] = one[i]
            one[one == label] = one[i]
    return sorted(found)


#: Side of a row inside its piece: it is compared with the others, is one of the others, or both.
ASKED, OTHER, BOTH = 0, 1, 2
PIECE = ["home", "block", "chunk"]
ROW = [*PIECE, "side", "node", "component"]
ROW_SCHEMA = "home long, block int, chunk int, side int, node long, component long"


def _sides(rows: list[tuple], make) -> tuple[_Side, _Side] | None:
    asked, others = ([r for r in rows if r[3] != wrong] for wrong in (OTHER, ASKED))
    if not asked or not others or len(rows) < 2:
        return None
    first = make(asked)
    return first, (first if rows[0][3] == BOTH else make(others))


def _by_piece(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
    for _, piece in groupby(rows, key=lambda row: row[:3]):
        yield list(piece)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*PIECE).sortWithinPartitions(*PIECE, "side", "node")


def _compare(pieces: DataFrame, nodes: DataFrame, documents: DataFrame, width: int, k: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components whose sets meet in a piece.

    First only sketches are moved, and rows without a candidate are dropped; the texts of the rest follow.
    """

    def from_sketches(rows: list[tuple]) -> _Side:
        sketched = [np.asarray(r[7], dtype=np.int64).view(np.uint64) for r in rows]
        return _Side(np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), sketched, None, k)

    def from_texts(rows: list[tuple]) -> _Side:
        sets = [shingle_set(r[6], width) for r in rows]
        return _Side(
            np.array([r[5] for r in rows]), np.array([len(s) for s in sets]), [s[:k] for s in sets], sets, k
        )

    def screened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_piece(batches):
            if (sides := _sides(rows, from_sketches)) is None:
                continue
            asked, others = sides
            likely = np.zeros(len(asked.sizes), dtype=bool), np.zeros(len(others.sizes), dtype=bool)
            for i, candidate in _candidates(asked, others, percent):
                likely[0][i] |= candidate.any()
                likely[1][:] |= candidate
            # Rows are sorted by side; where a row is both, either reason keeps it.
            keep = likely[0] | likely[1] if asked is others else np.concatenate(likely)
            if keep.any():
                yield pd.DataFrame([r[:6] for r, wanted in zip(rows, keep, strict=True) if wanted], columns=ROW)

    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_piece(batches):
            if (sides := _sides(rows, from_texts)) and (links := _linked(*sides, percent)):
                yield pd.DataFrame(links, columns=["a", "b"])

    pieces = stage(pieces, "near-pieces")
    met, _ = likely_members(nodes.select("node", "n_shingles", "sketch"), "node", pieces.select("node").distinct())
    sketched = pieces.join(met, "node")
    likely = stage(
        _dealt(sketched.select(*ROW, "n_shingles", "sketch")).mapInPandas(screened, ROW_SCHEMA), "near-likely"
    )
    texts, _ = likely_members(documents, "node", likely.select("node").distinct())
    read = likely.join(texts, "node").select(*ROW, "text")
    links = stage(_dealt(read).mapInPandas(confirmed, "a long, b long"), "near-links")
    discard(pieces)
    discard(likely)
    return links


def _blocks(count: Column) -> Column:
    return F.ceil(count / BLOCK_ROWS).cast("int")


def _pieces(asked: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of :func:`_compare`. ``asked`` and ``others`` are ``(home, node, component)``.

    Inside a home both sides are dealt out over blocks of bounded size, and each block of one side meets
    each block of the other.
    """
    sizes = stage(
        others.groupBy("home").agg(_blocks(F.count(F.lit(1))).alias("blocks")).join(
            asked.groupBy("home").agg(_blocks(F.count(F.lit(1))).alias("chunks")), "home"
        ),
        "near-homes",
    )
    place = F.xxhash64("node")
    all_blocks, all_chunks = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("blocks", "chunks"))
    one = asked.join(sizes, "home").withColumns(
        {"chunk": F.pmod(place, F.col("chunks")).cast("int"), "block": all_blocks, "side": F.lit(ASKED)}
    )
    two = others.join(sizes, "home").withColumns(
        {"block": F.pmod(place, F.col("blocks")).cast("int"), "chunk": all_chunks, "side": F.lit(OTHER)}
    )
    return one.select(*ROW).unionByName(two.select(*ROW))


def _nodes(sketched: DataFrame) -> DataFrame:
    """``node, n_shingles, digest, sketch``: one row per digest, named by the smallest key.

    Only sketches of digests that occur more than once are shuffled.
    """
    marked = sketched.withColumn("place", F.xxhash64("digest"))
    counted = marked.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counted.where("n > 1").select("place"), "near-repeated")
    columns = ["node", "n_shingles", "digest", "sketch"]
    some, single = likely_members(marked, "place", repeated)
    merged = some.groupBy("digest").agg(
        F.min("key").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    return single.withColumnRenamed("key", "node").select(columns).unionByName(merged.select(columns))


def _asked_in_short(entries: DataFrame, percent: int) -> DataFrame:
    """``to, node, n_shingles, component``, once for every list of ``GATHERED`` members at most, whose rows are shuffled once."""
    parts, whole = Window.partitionBy("value", "component"), Window.partitionBy("value")
    member = F.struct("n_shingles", "component", "home")
    gathered = entries.repartition("value").withColumn("n", F.count(F.lit(1)).over(parts)).withColumns(
        {"main": F.max(F.struct("n", "component")).over(whole)["component"], "members": F.collect_set(member).over(whole)}
    )
    reached = F.expr(f"""array_distinct(transform(filter(members, m -> m.component <> component
        AND m.home <> home AND n_shingles * 100 >= m.n_shingles * {percent}
        AND m.n_shingles * 100 >= n_shingles * {percent}), m -> m.home))""")
    return gathered.where("component <> main").select(F.explode(reached).alias("to"), "node", "n_shingles", "component")


def _asked_in_long(entries: DataFrame, percent: int) -> DataFrame:
    """The same for lists of any length; none is gathered."""
    per_list = entries.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = per_list.groupBy("value").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component"))["component"].alias("main")
    ).where("parts > 1")
    mixed = stage(entries.join(stage(mixed, "near-mixed"), "value"), "near-mixed")
    reached = mixed.groupBy("value", F.col("home").alias("to")).agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most")
    )
    asked = mixed.where("component <> main").select("value", "node", "n_shingles", "component", "home").join(
        stage(reached, "near-reached"), "value"
    ).where(f"to <> home AND n_shingles * 100 >= least * {percent} AND most * 100 >= n_shingles * {percent}")
    return asked.select("to", "node", "n_shingles", "component")


def _asked_at_home(members: DataFrame) -> DataFrame:
    """``home, node, component`` of the members of homes outside the most frequent component of their home.

    Of two members in different components one is asked at least, once for all lists that they share.
    """
    parts = members.groupBy("home", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("home").agg(F.max(F.struct("n", "component"))["component"].alias("main"))
    return members.join(stage(main, "near-mains"), "home").where("component <> main").select("home", "node", "component")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80, k: int = 128) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row of ``documents``.

    Rows are linked if ``100 * |intersection| >= percent * |union|`` of their shingle sets; the component is the
    smallest key reachable, ``kept`` marks it. NULL, empty and blank texts have no shingles and are linked
    with nothing. Rows that share a key are one document: a link of one is a link of all. A NULL key
    takes no part: its component is NULL and it is kept. An empty table gives an empty result. Other columns
    are not read. The chance to miss one linked pair is ``MISS``.
    """
    has(documents, key=key, text=text)
    with small_batches(documents.sparkSession, TEXTS):
        return _near_duplicates(documents, key, text, width, percent, k)


def _near_duplicates(documents: DataFrame, key: str, text: str, width: int, percent: int, k: int) -> DataFrame:
    sketched = stage(sketches(documents, key, text, width, k), "near-sketches")
    found = stage(sketched.drop("sketch"), "near-documents")
    nodes = stage(_nodes(sketched.where("n_shingles > 0 AND key IS NOT NULL")), "near-nodes")
    discard(sketched)
    entries = stage(index_entries(nodes, k, percent), "near-entries")
    lists = entries.groupBy("value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    lists = stage(lists, "near-lists")
    by_set = stage(nodes.select("digest", "node"), "near-sets")
    some, _ = likely_members(nodes.drop("digest"), "node", entries.where("value = home").select("node"))
    listed_nodes = stage(some, "near-nodes")
    discard(nodes)
    nodes = listed_nodes
    texts = documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))

    # Homes of up to a block are compared in full, the members of larger ones with one of them.
    homes = entries.where("value = home").select("node", "n_shingles", "home", F.col("node").alias("component"))
    sizes = stage(homes.groupBy("home").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre")),
                  "near-sizes")
    homes = stage(homes.join(sizes, "home"), "near-homes")
    # Of at most a block of members, those without another of a like size have nothing to link with.
    by_size = Window.partitionBy("home").orderBy("n_shingles", "node")
    n, smaller, larger = F.col("n_shingles"), F.lag("n_shingles").over(by_size), F.lead("n_shingles").over(by_size)
    alike = F.coalesce(smaller * 100 >= n * percent, F.lit(False)) | F.coalesce(n * 100 >= larger * percent, F.lit(False))
    small = homes.where(f"size BETWEEN 2 AND {BLOCK_ROWS}").withColumn("alike", alike).where("alike").select(
        "home", F.lit(0).alias("block"), F.lit(0).alias("chunk"), F.lit(BOTH).alias("side"), "node", "component"
    )
    large = homes.where(f"size > {BLOCK_ROWS}").select("home", "node", "component", "centre")
    around = _pieces(large.where("node = centre").drop("centre"), large.where("node <> centre").drop("centre"))
    links = _compare(small.unionByName(around), nodes, texts, width, k, percent)
    first = stage(components(links), "near-first")

    # Lists that still have several components: members outside the most frequent one against all
    # members of the other homes that the list reaches, and of their own if that is larger than a block. Most lists are short and have no member that the first round joined.
    labels = homes.select("node", "home", "size").join(first, "node", "left").select(
        "node", "home", "size", F.coalesce("component", "node").alias("component")
    )
    labels = stage(labels, "near-labels")
    shared, _ = likely_members(entries, "value", lists)
    moved, single = likely_members(shared, "node", first)
    single = single.withColumn("component", F.col("node"))
    moved = moved.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    large = sizes.where(f"size > {BLOCK_ROWS}").select("home", F.lit(True).alias("large"))
    labelled = single.unionByName(moved.select(single.columns)).join(
        F.broadcast(large), "home", "left"  # one row for every block of nodes at most
    ).withColumn("large", F.coalesce("large", F.lit(False)))
    labelled = stage(labelled, "near-labelled")
    discard(entries)
    long, short = likely_members(labelled, "value", lists.where(f"members > {GATHERED}"))
    asked = _asked_in_short(short, percent).unionByName(_asked_in_long(long, percent))
    asked = asked.groupBy(F.col("to").alias("home"), "node", "n_shingles", "component").agg(
        F.count(F.lit(1)).alias("lists")
    ).where(F.col("lists") >= _meetings(F.col("n_shingles"), k, percent))
    asked = asked.select("home", "node", "component").unionByName(_asked_at_home(labelled.where("large AND value = home")))
    asked = stage(asked, "near-asked")
    discard(labelled)
    discard(lists)
    links = _compare(_pieces(asked, labels.select("home", "node", "component")), nodes, texts, width, k, percent)
    second = stage(components(links), "near-second")

    joined = first.join(second.select(F.col("node").alias("component"), F.col("component").alias("last")), "component",
                        "left").select("node", F.coalesce("last", "component").alias("component"))
    # Single nodes of the first round may be part of a component of the second.
    labels = stage(joined.unionByName(second.join(first.select("node"), "node", "left_anti")), "near-labels")
    by_set = by_set.join(labels, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component")
    )
    by_set = stage(by_set, "near-components")
    result = found.select("key", "n_shingles", "digest").join(by_set, "digest", "left").select(
        F.col("key").alias(key), "n_shingles",
        F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id"),
    )
    return result.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def deduplicate(documents: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents without those that are near-duplicates of one with a smaller key; all columns stay.

    Of rows that share a key one stays. Rows with a NULL key, and documents without words, all stay.
    """
    found = stage(near_duplicates(documents, key, **options).select(key, "kept"), "near-result")
    repeated = found.where(f"{key} IS NOT NULL").groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    repeated = stage(repeated.where("n > 1"), "near-repeated")
    single = without(documents, key, found.where("NOT kept").select(key).unionByName(repeated.select(key)).distinct())
    if repeated.isEmpty():
        return single
    one_of_each = members(documents, key, repeated.where("kept").select(key)).dropDuplicates([key])
    return single.unionByName(one_of_each)
