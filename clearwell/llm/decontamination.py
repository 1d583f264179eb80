"""Benchmark passages in documents, up to a share of edited words.

Words are compared. A random walk over a sequence of words writes out the word it stands on and then goes
on to the next one or stays, as a random bit of word and step says (CGK embedding); two sequences at a
small edit distance so become two outputs at a small Hamming distance. Every word of a document starts a window. Outputs are sampled at
a few steps, again and again with new bits; where a window's samples equal those of an item, the
pair is a candidate. With as many edits as are allowed here, two walks from the first word lose each other long before
the end, so every repetition sets off from another place of item and window, drawn from the whole length, and samples a
stretch from there: edits anywhere leave other places. Items are handled in classes of about equal length. The number of
repetitions is set by trials on items with as many edits as are allowed, spread or all in one place, so that the
target recall is reached.

Two tests around that change no result. Before it, windows are left out that have too few rare words of the items: a passage
has lost no more words than there are edits. Behind it, the exact edit distance decides.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.llm.membership import likely_members
from clearwell.session import discard, small_batches, stage

SAMPLES = 3
#: Repetitions beyond which building the index fails instead of missing its recall.
MOST_REPETITIONS = 200
#: Trials for each place of the edits.
TRIALS = 300
#: By how much the trials must exceed the recall asked for, as they are a sample.
MARGIN = 0.03
#: Words handled at once; longer documents are handled in overlapping pieces.
PIECE = 1 << 18
#: Steps of a walk, about two a word, that samples are drawn from; fewer than the bits of a hash.
STRETCH = 10
#: Items that one pass over the documents looks for.
ITEMS_PER_PASS = 20_000
#: Texts that are searched together.
TEXTS = 512

_WORD = re.compile(r"[^\W_]+")
#: Scripts without blanks between words: Thai, Lao, Burmese, Khmer, Japanese and Chinese.
_SCRIPTS = (
    r"\u0e01-\u0e4e\u0e80-\u0ecd\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    r"\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_UNSPACED = re.compile(f"[{_SCRIPTS}]")
_WORD_OR_SIGN = re.compile(rf"[^\W_{_SCRIPTS}]+|(?=[^\W_])[{_SCRIPTS}]")
_STOP = 1


def normalised_words(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; in scripts without blanks every letter is one by itself."""
    lowered = (text or "").lower()
    spaced = lowered.isascii() or not _UNSPACED.search(lowered)
    return (_WORD if spaced else _WORD_OR_SIGN).findall(lowered)


_ASCII = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256)).lower()


def _split(text: str | None) -> list:
    """:func:`normalised_words`, as bytes where a text is ASCII, for which that is much faster."""
    if text and text.isascii():
        return text.encode().translate(_ASCII).split()
    return normalised_words(text)


def _bits(n: int, repetition: int) -> np.ndarray:
    """64 random bits for each of the numbers below ``n``; none for the end (1), where a walk stays for good."""
    x = np.arange(n, dtype=np.uint64) + np.uint64(((repetition + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    x[_STOP] = 0
    return x.view(np.int64)


def _distances(item: list[int], window: list[int], free_start: bool) -> list[int]:
    """Edit distance of the item from the window's part that ends behind each of its words (and before the first).

    The part begins where the window does, or anywhere with ``free_start``. Bit-parallel: a Python integer holds
    a whole column of the table, as differences between neighbouring cells.
    """
    m = len(item)
    last, full = 1 << (m - 1), (1 << m) - 1
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    up, down, distance = full, 0, m
    out = [m]
    for word in window:
        match = places.get(word, 0)
        across = match | down
        zero = (((match & up) + up) ^ up) | match
        right, left = down | ~(zero | up) & full, up & zero
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right = (right << 1 | (not free_start)) & full
        left = left << 1 & full
        up, down = left | ~(across | right) & full, right & across
        out.append(distance)
    return out


def best_passage(item: list[int], window: list[int], most: int) -> tuple[int, int, int] | None:
    """``(distance, start, words)`` of the part of the window that is nearest to the item; None beyond ``most``.

    Of parts at the same distance the one whose end is first, then the one whose length is nearest to the item's.
    """
    distances = _distances(item, window, free_start=True)
    distance = min(distances)
    if distance > most:
        return None
    end = distances.index(distance)
    back = _distances(item[::-1], window[:end][::-1], free_start=False)
    length = min((abs(n - len(item)), n) for n, d in enumerate(back) if d == distance)[1]
    return distance, end - length, length


def _edited(item: list[int], edits: int, place: str, r: random.Random) -> list[int]:
    """The item with so many words replaced, inserted or deleted, all over it or in one stretch. 0 is any other word."""
    out, n = list(item), len(item)
    first = {"spread": 0, "front": 0, "middle": (n - edits) // 2, "back": n - edits}[place]
    among = range(n) if place == "spread" else range(first, first + edits)
    kind = None if place == "spread" else r.randrange(4)
    for at in sorted(r.sample(among, edits), reverse=True):
        what = r.randrange(3) if kind in (None, 3) else kind
        if what == 0:
            out[at] = 0
        elif what == 1:
            out.insert(at, 0)
        else:
            del out[at]
    return out


PLACES = ("spread", "front", "middle", "back")


@dataclass
class _Class:
    """Items of at least ``words`` words and about a quarter more at most."""

    words: int
    items: list[int]
    anchors: list[int] = field(default_factory=list)
    steps: list[list[int]] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)


@dataclass
class Finder:
    """Items with what is needed to find them; its size grows with the words of the items. Built on the driver, used in
    tasks. Words of items are numbered from 2 on; 0 is any other word, 1 the end of a document."""

    item_ids: list
    words: list[list[str]]
    similarity: float
    recall: float
    least_words: int

    def __post_init__(self):
        vocabulary = sorted({w for item in self.words for w in item})
        self.number = {w: i + 2 for i, w in enumerate(vocabulary)}
        self.number |= {w.encode(): i for w, i in self.number.items() if w.isascii()}
        self.size = len(vocabulary) + 2
        self.items = [[self.number[w] for w in item] for item in self.words]
        self.most = [int(len(w) * (1 - self.similarity) + 1e-9) for w in self.words]
        self._tables: dict[int, np.ndarray] = {}
        self._thresholds: list | None = None
        self.classes, words = [], self.least_words
        longest = max(map(len, self.items), default=0)
        while words <= longest:
            upto = max(words + 1, words * 5 // 4)
            if items := [i for i, w in enumerate(self.items) if words <= len(w) < upto]:
                self.classes.append(self._class(words, items))
            words = upto
        # Shorter items only count where they are the whole document.
        self.whole: dict[tuple[int, ...], list[int]] = {}
        for i, h in enumerate(self.items):
            if 0 < len(h) < self.least_words:
                self.whole.setdefault(tuple(h), []).append(i)

    def __getstate__(self):
        return self.__dict__ | {"_tables": {}, "_thresholds": None}

    @cached_property
    def overlap(self) -> int:
        """Words that neighbouring pieces of a document share, so that a passage is whole in one of them."""
        return max([len(h) + 3 * m for h, m in zip(self.items, self.most, strict=True)], default=0)

    @cached_property
    def lead(self) -> int:
        """Other words put before a document: an item that has lost its first words begins before the passage does."""
        return max(self.most, default=0)

    def numbers(self, text: str | None) -> list[int]:
        get = self.number.get
        return [get(w, 0) for w in _split(text)]

    def _class(self, words: int, items: list[int]) -> _Class:
        found, r = _Class(words, items), random.Random(words)
        ends = np.cumsum([len(self.items[i]) + 1 for i in items])
        joined = np.array([w for i in items for w in [*self.items[i], _STOP]])
        first = ends - [len(self.items[i]) + 1 for i in items]
        trials = self._trials(found)
        met = {place: np.zeros(TRIALS, dtype=bool) for place in PLACES}
        while len(found.steps) < MOST_REPETITIONS:
            repetition = len(found.steps)
            anchor = r.randrange(max(1, words - 2))
            steps = sorted(r.sample(range(min(STRETCH, 2 * (words - anchor) - 1)), SAMPLES))
            keys = self._keys(joined, first + anchor, repetition, steps)
            order = np.argsort(keys, kind="stable")
            found.anchors.append(anchor)
            found.steps.append(steps)
            found.keys.append(keys[order])
            found.owners.append(np.array(items)[order])
            for place, (numbers, windows, trial, wanted) in trials.items():
                rows, owners = self._collisions(found, repetition, numbers, windows)
                hit = owners == wanted[trial[rows]]
                met[place][trial[rows[hit]]] = True
            if all(m.mean() >= min(1.0, self.recall + MARGIN) for m in met.values()):
                return found
        reached = {place: round(float(m.mean()), 3) for place, m in met.items()}
        raise ValueError(f"{MOST_REPETITIONS} repetitions do not reach the recall of {self.recall}: {reached}")

    def _trials(self, of: _Class) -> dict:
        """Edited items by place: their words, windows to look at, the trial of each window, the items sought."""
        r, out = random.Random(1), {}
        for place in PLACES:
            joined, windows, trial, wanted = [], [], [], []
            for n in range(TRIALS):
                i = r.choice(of.items)
                item, most = self.items[i], self.most[i]
                passage = [0] * most + _edited(item, most, place, r) + [0] * (len(item) + most)
                known = set(item)
                for start in range(2 * most + 1):
                    # Only windows that the test of rare words is sure to leave.
                    if sum(w in known for w in passage[start : start + len(item) + most]) >= len(item) - most:
                        windows.append(len(joined) + start)
                        trial.append(n)
                wanted.append(i)
                joined += passage
            out[place] = np.array([*joined, _STOP]), np.array(windows, dtype=int), np.array(trial, dtype=int), np.array(wanted)
        return out

    def _table(self, repetition: int) -> np.ndarray:
        if repetition not in self._tables:
            self._tables[repetition] = _bits(self.size, repetition)
        return self._tables[repetition]

    def _keys(self, numbers: np.ndarray, starts: np.ndarray, repetition: int, steps: list[int]) -> np.ndarray:
        """Samples of the walks from ``starts``, mixed into one number each."""
        at, key, bits = starts, np.zeros(len(starts), dtype=np.uint64), self._table(repetition)
        for step in range(steps[-1] + 1):
            word = numbers[at]
            if step in steps:
                key = (key ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            at = at + ((bits[word] >> step) & 1)
        return key

    def _collisions(self, of: _Class, repetition: int, numbers: np.ndarray, starts: np.ndarray):
        """Rows of ``starts`` and the items whose samples they share."""
        if not len(starts):
            return starts, starts
        # Behind the last word a walk stands on the last end.
        begin = np.minimum(starts + of.anchors[repetition], len(numbers) - 1)
        keys, known = self._keys(numbers, begin, repetition, of.steps[repetition]), of.keys[repetition]
        first, last = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
        hit = np.flatnonzero(last > first)
        length = (last - first)[hit]
        rows = np.repeat(hit, length)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(length) - length, length) + first[rows]
        return rows, of.owners[repetition][places]

    def _rare(self, of: _Class, frequency: np.ndarray, extra: float) -> tuple[np.ndarray, int, int]:
        """Which words are among the rarest of an item, how many of them a window has at least, and its length.

        Of the rarest ``most + extra`` words of an item at most ``most`` are lost. Any choice of words is right; rare
        ones leave fewer windows.
        """
        flags, needed, span = np.zeros(self.size, dtype=bool), None, 0
        for i in of.items:
            item, most = self.items[i], self.most[i]
            n = min(len(item), most + max(1, int(extra * len(item))))
            flags[sorted(item, key=lambda w: (frequency[w], w))[:n]] = True
            needed = n - most if needed is None else min(needed, n - most)
            span = max(span, len(item) + most)
        return flags, needed, span

    def _windows(self, of: _Class, rare: tuple[np.ndarray, int, int], numbers: np.ndarray) -> np.ndarray:
        flags, needed, span = rare
        before = np.concatenate([[0], np.cumsum(flags[numbers], dtype=np.int32)])
        ends = np.minimum(np.arange(span, len(numbers) + span), len(numbers))
        return np.flatnonzero(before[ends] - before[:-1] >= needed)

    def search(self, numbers: np.ndarray, document: np.ndarray, first: np.ndarray) -> dict:
        """Best ``(distance, start, words)`` by ``(document, item)`` in joined documents.

        Every document ends with the stop; ``document`` tells whose word each is, ``first`` its place there.
        """
        if self._thresholds is None:
            # How rare words are is taken from the first documents that a task sees; the results do not depend on it.
            frequency = np.bincount(numbers, minlength=self.size)
            options = ([self._rare(of, frequency, e) for e in (0.05, 0.15, 0.3, 0.5, 0.8)] for of in self.classes)
            self._thresholds = [
                min(rare, key=lambda x: len(self._windows(of, x, numbers)))
                for of, rare in zip(self.classes, options, strict=True)
            ]
        near: dict[tuple[int, int], set[int]] = {}
        for of, rare in zip(self.classes, self._thresholds, strict=True):
            starts = self._windows(of, rare, numbers)
            for repetition in range(len(of.steps)):
                rows, items = self._collisions(of, repetition, numbers, starts)
                for start, item in zip(starts[rows].tolist(), items.tolist(), strict=True):
                    near.setdefault((int(document[start]), item), set()).add(start)
        return {pair: found for pair, starts in near.items() if (found := self._nearest(pair, starts, numbers, document, first))}

    def _nearest(self, pair, starts: set[int], numbers, document, first) -> tuple[int, int, int] | None:
        """The best passage around some starts of windows; places that one window covers are looked at once."""
        owner, i = pair
        item, most, best, done = self.items[i], self.most[i], None, -1
        known, begin = set(item), int(np.searchsorted(document, owner, "left")) + self.lead
        stop = int(np.searchsorted(document, owner, "right")) - 1
        for start in sorted(starts):
            if start < done:
                continue
            low, done = max(begin, start - most), min(stop, max(begin, start) + len(item) + 2 * most)
            window = numbers[low:done].tolist()
            if sum(w in known for w in window) < len(item) - most:
                done = start + 1
                continue
            found = best_passage(item, window, most)
            # The next window may reach beyond this one.
            done = start + most + 1
            if found and (best is None or found[0] < best[0]):
                best = found[0], int(first[low + found[1]]) if found[2] else int(first[low]), found[2]
        return best

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, item, distance, start, words)`` of the best passage of every item in every text."""
        waiting: list[tuple[int, int, list[int]]] = []

        def search() -> dict:
            before = [0] * self.lead
            numbers = np.array([w for _, _, part in waiting for w in [*before, *part, _STOP]], dtype=np.int64)
            lengths = [self.lead + len(part) + 1 for _, _, part in waiting]
            document = np.repeat(np.arange(len(waiting)), lengths)
            first = np.concatenate([
                np.arange(offset - self.lead, offset - self.lead + n) for (_, offset, _), n in zip(waiting, lengths, strict=True)
            ])
            found: dict = {}
            for (place, item), value in self.search(numbers, document, first).items():
                self._merge(found, {(waiting[place][0], item): value})
            waiting.clear()
            return found

        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        words = 0
        for i, text in enumerate(texts):
            numbers = self.numbers(text)
            for item in self.whole.get(tuple(numbers), ()) if 0 < len(numbers) < self.least_words else ():
                best[(i, item)] = (0, 0, len(numbers))
            for offset in range(0, len(numbers), PIECE):
                part = numbers[offset : offset + PIECE + self.overlap]
                waiting.append((i, offset, part))
                words += len(part)
                if words >= PIECE:
                    self._merge(best, search())
                    words = 0
        if waiting:
            self._merge(best, search())
        for (i, item), (distance, start, length) in sorted(best.items()):
            yield i, item, distance, start, length

    @staticmethod
    def _merge(best: dict, more: dict) -> None:
        for pair, value in more.items():
            best[pair] = min(value, best.get(pair, value))


def _finders(documents: DataFrame, benchmark: DataFrame, item: str, item_text: str, similarity: float, recall: float,
             least_words: int) -> Iterator:
    """Broadcast finders, one for each block of at most ``ITEMS_PER_PASS`` items."""
    spark, block = documents.sparkSession, []

    def finder():
        return spark.sparkContext.broadcast(
            Finder([i for i, _ in block], [w for _, w in block], similarity, recall, least_words)
        )

    for row in benchmark.select(item, item_text).where(F.col(item_text).isNotNull()).orderBy(item, item_text).toLocalIterator():
        if words := normalised_words(row[1]):
            block.append((row[0], words))
        if len(block) == ITEMS_PER_PASS:
            yield finder()
            block = []
    if block:
        yield finder()


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", similarity: float = 0.8, recall: float = 0.95,
                 least_words: int = 5) -> DataFrame:
    """One row per document and benchmark item that it holds: key, item, the number of words of the item, the
    smallest edit distance in words, where that passage begins, how many words it has and its normalised text.

    An item is held if some passage differs from it by at most ``1 - similarity`` times its words. Passages at
    that limit are found with the target recall wherever the edits are, nearer ones more often; if the recall cannot be
    reached the call fails. Items with fewer than ``least_words`` words only count where they are the whole document. NULL,
    empty and wordless texts hold nothing and are held by none. Keys and items keep their types and may be NULL. Rows that share a key
    give a row each. Empty tables give an empty result; other columns are not read. The benchmark is a
    query set: it is worked off in passes of ``ITEMS_PER_PASS`` items over all documents.
    """
    has(documents, key=key, text=text)
    has(benchmark, item=item, item_text=item_text)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kinds = rows.schema["key"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"key {kinds[0]}, item_id {kinds[1]}, item_words int, distance int, first_word long, n_words int, text string"
    found = documents.sparkSession.createDataFrame([], schema)
    for finder in _finders(documents, benchmark, item, item_text, similarity, recall, least_words):
        found = found.unionByName(_search(rows, finder, schema))
    return found.withColumnsRenamed({"key": key, "item_id": item})


def _search(rows: DataFrame, shared, schema: str) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                texts = batch.column(1).slice(start, TEXTS).to_pylist()
                hits = list(finder.find(texts))
                if not hits:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, TEXTS).take(pa.array([h[0] for h in hits])),
                        pa.array([finder.item_ids[h[1]] for h in hits]),
                        pa.array([len(finder.words[h[1]]) for h in hits], pa.int32()),
                        pa.array([h[2] for h in hits], pa.int32()),
                        pa.array([h[3] for h in hits], pa.int64()),
                        pa.array([h[4] for h in hits], pa.int32()),
                        pa.array([" ".join(normalised_words(texts[h[0]])[h[3] : h[3] + h[4]]) for h in hits]),
                    ],
                    names=["key", "item_id", "item_words", "distance", "first_word", "n_words", "text"],
                )

    return rows.mapInArrow(found, schema)


def remove(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
           item_text: str = "text", similarity: float = 0.8, recall: float = 0.95, least_words: int = 5) -> DataFrame:
    """The rows whose text holds no item of the benchmark, with all columns.

    Every row is judged by its own text, whatever its key. Python is sent a few texts at a time, and what comes back are the
    digests of those that hold an item; these are staged, pass by pass, so a task has one worker. Rows are
    dropped by them where they stand; only those that may have such a digest are joined.
    """
    has(documents, text=text)
    has(benchmark, item=item, item_text=item_text)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(row.alias("row"), F.sha2(F.col(text), 256).alias("digest")).withColumn("place", F.xxhash64("digest"))
    texts = documents.select(F.sha2(F.col(text), 256).alias("digest"), F.col(text).alias("text")).where("text IS NOT NULL")
    held = []
    for shared in _finders(documents, benchmark, item, item_text, similarity, recall, least_words):

        def holding(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = shared.value
            for batch in batches:
                for start in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(start, TEXTS)
                    if hits := sorted({hit[0] for hit in finder.find(part.column(1).to_pylist())}):
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(hits))], names=["digest"])

        with small_batches(documents.sparkSession, TEXTS):
            held.append(stage(texts.mapInArrow(holding, "digest string"), "held-texts"))
    if not held:
        return documents
    digests = stage(reduce(DataFrame.unionByName, held).distinct(), "held-texts")
    for table in held:
        discard(table)
    likely, others = likely_members(rows, "place", digests.select(F.xxhash64("digest")))
    kept = likely.join(digests, "digest", "left_anti").select("row.*")
    return others.select("row.*").unionByName(kept)
