"""Periodic runs of words: the same few words again and again.

A run is a stretch of at least ``EXPONENT`` times its smallest period that cannot be made longer. Periods are
handled in classes, ``2**j <= period < 2**(j+1)``. Words one period apart agree over at least three periods
of a run, so over at least ``3 * 2**j`` words (``LEAST_WORDS - 1`` for period 1): that is the length of the grams
that the class indexes. Equal grams of one document lie on a diagonal, which is named by their lag.

Of all occurrences of a gram only neighbouring ones have to be paired, as the grams are at least as long as the
period: inside a run the next occurrence of a gram is exactly one period further on. Were it nearer, the words
that both cover would have two periods and so, by the theorem of Fine and Wilf, a smaller common one.
So every run is seeded with its smallest period, and the pairs of a class are no more than the words.

A seed is extended both ways along its diagonal until words differ. A table of the furthest word
covered on every lag skips the other seeds of the same stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.llm.shingles import word_hashes

#: A run has at least so many periods, and at least so many words.
EXPONENT, LEAST_WORDS = 4, 6
#: Words of short documents that are handled together.
TOGETHER = 1 << 17

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left ^ (right * _MIX + (right >> np.uint64(31)))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _neighbours(grams: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds: places whose gram occurs next after a lag from ``low`` to ``high - 1``, by lag and place."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    first, lag = at[order[:-1]][same], (at[order[1:]] - at[order[:-1]])[same]
    fits = (lag >= low) & (lag < high)
    first, lag = first[fits], lag[fits]
    by_lag = np.lexsort((first, lag))
    return first[by_lag], lag[by_lag]


def _agreeing(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in direction ``step``, equal the word one lag further on."""
    most = len(words) - lag - at if step > 0 else at + 1
    done, size = 0, 32
    while done < most:
        n = min(size, most - done)
        first = at + done if step > 0 else at - done - n + 1
        equal = words[first : first + n] == words[first + lag : first + lag + n]
        if not equal.all():
            return done + int(np.argmin(equal if step > 0 else equal[::-1]))
        done, size = done + n, size * 4
    return done


def _extended(words: np.ndarray, first: np.ndarray, lags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches ``(start, end, lag)`` of the seeds, each once."""
    i, covered = 0, {}
    while i < len(first):
        place, lag = int(first[i]), int(lags[i])
        furthest = covered.get(lag, -1)
        if place < furthest:
            # The seeds of a lag stand together: go to the first one beyond, or to the next lag.
            last = i + int(np.searchsorted(lags[i:], lag, "right"))
            i += int(np.searchsorted(first[i:last], furthest, "left"))
            continue
        start = place - _agreeing(words, place - 1, lag, -1) if place else 0
        end = place + _agreeing(words, place, lag, 1)
        # An unlucky hash may name a place whose words do not agree at all.
        covered[lag] = max(end, place + 1)
        yield start, end + lag, lag
        i += 1


def find_runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of the runs of several documents, by start, then period.

    ``words`` are hashes of all their words; document ``d`` ends before ``ends[d]``. Starts count from the first
    word of the first document.
    """
    lengths = np.diff(np.concatenate([[0], ends]))
    document = np.repeat(np.arange(len(ends), dtype=np.uint64), lengths)
    words = _mixed(words, document)  # no word agrees with one of another document
    n_of = np.repeat(lengths, lengths)
    at = np.flatnonzero(n_of >= LEAST_WORDS)
    power = words  # hashes of the 2**j words from every place
    found, low = [], 1
    while len(at):
        k = 3 * low if low > 1 else LEAST_WORDS - 1
        if low == 1:
            grams = words
            for step in range(1, k):
                grams = _mixed(grams[: len(words) - step], words[step:])
        else:
            double = _mixed(power[: len(power) - low], power[low:])
            grams = _mixed(double[: len(double) - low], power[2 * low :])
        seeds = at[at < len(grams)]
        for start, end, lag in _extended(words, *_neighbours(grams[seeds], seeds, low, 2 * low)):
            if end - start >= max(LEAST_WORDS, EXPONENT * lag):
                found.append((start, end - start, lag))
        power = _mixed(power[: len(power) - low], power[low:])
        low *= 2
        at = at[n_of[at] >= EXPONENT * low]
    runs = np.array(sorted(found, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)
    return runs[:, 0], runs[:, 1], runs[:, 2]


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0))


def _analysed(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """Number of words, runs and collapsed text of every text."""
    waiting: list[list[bytes]] = []
    n = 0
    for i, text in enumerate(texts):
        waiting.append((text or "").encode("utf-8", "surrogatepass").split())
        n += len(waiting[-1])
        if n < TOGETHER and i + 1 < len(texts):
            continue
        ends = np.cumsum([len(w) for w in waiting])
        start, length, period = find_runs(np.concatenate([word_hashes(w) for w in waiting]), ends)
        first = np.searchsorted(start, np.concatenate([[0], ends]), "left")
        for d, words in enumerate(waiting):
            part = slice(first[d], first[d + 1])
            offset = ends[d] - len(words)
            runs = list(zip((start[part] - offset).tolist(), length[part].tolist(), period[part].tolist(), strict=True))
            yield len(words), runs, _kept(words, runs).decode("utf-8", "surrogatepass")
        waiting, n = [], 0


RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, runs, collapsed`` of every row.

    Words are runs of characters other than ASCII white space, compared as they are, and numbered from 0. ``runs`` holds
    ``(start, length, period)`` by start, then period; ``collapsed`` is the text without the words that a run contains
    after its first period, its words joined by one blank. NULL, empty and blank texts have no words, no runs
    and an empty collapsed text. Rows that repeat, or share a key or have none, give a row each. An empty
    table gives an empty result. Keys keep their type; other columns are not read. Words are compared by 64-bit hashes.
    """
    has(documents, key=key, text=text)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_words long, runs array<{RUN}>, collapsed string"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def analysed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n_words, runs, collapsed = zip(*_analysed(part.column(1).to_pylist()), strict=True)
                named = [[{"start": s, "length": n, "period": p} for s, n, p in of] for of in runs]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(named, run_type), pa.array(collapsed, pa.string())],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(analysed, schema).withColumnRenamed("key", key)
