"""Top-k against all scores, computed with Python integers."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clearwell.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_all_scores(rows, step, k):
    good = [
        (i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for n, (q, x) in enumerate(good):
        if q % step == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(x, y, strict=True)), i)
                for m, (i, y) in enumerate(good) if m != n and len(y) == len(x)
            )
            out.update((q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1))
    return out


def found(llm, rows, step=3, k=5):
    df = llm.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    df = df.selectExpr("*", "1 AS query", "2 AS block", "3 AS score")
    return Counter(tuple(r) for r in topk.top_k(df, F.col("vec_id") % step == 0, k).collect())


def exact(v):
    """Values that a float holds exactly."""
    return [round(x * 64) / 64 for x in v]


@pytest.mark.parametrize("dimensions", [1, 2, 8, 40])
def test_equals_all_scores(llm, dimensions):
    r = random.Random(dimensions)
    rows = [(i, exact(r.gauss(0, 1) for _ in range(dimensions))) for i in range(700)]
    rows += [(i, rows[i % 7][1]) for i in range(700, 900)]
    assert found(llm, rows) == by_all_scores(rows, 3, 5)


def test_ties_go_to_the_smaller_key_and_few_candidates_are_all_returned(llm):
    rows = [(i, [1.0, 2.0]) for i in range(20)]
    assert found(llm, rows) == by_all_scores(rows, 3, 5)
    assert found(llm, rows[:3]) == by_all_scores(rows[:3], 3, 5)
    assert found(llm, rows[:1]) == found(llm, []) == Counter()


def test_hostile_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (1, None), (2, []), (3, [nan, 1.0]), (6, [inf, 0.0]), (9, [None, 1.0]), (None, [1.0, 1.0]),
            (12, [0.5, 0.5]), (12, [0.5, 0.5]), (12, [9.0, 9.0]), (4, [2.0, 0.0]), (5, [1.0]), (15, [3.0]), (7, [-1.0, -1.0]), (8, [0.0, 0.0])]
    assert found(llm, rows) == by_all_scores(rows, 3, 5)


def test_scores_beyond_exact_doubles(llm):
    rows = [(i, [2.0**22 + i, 2.0**16 * i]) for i in range(12)]
    assert found(llm, rows) == by_all_scores(rows, 3, 5)


def test_reading_stops_early_where_scores_are_spread():
    import numpy as np

    values = np.zeros((4000, 4))
    values[:, 0] = np.arange(4000)
    lists = topk.SortedLists(np.arange(4000), values)
    seen = []
    original = lists.sorted

    class Spy:
        def __getitem__(self, i):
            seen.append(i)
            return original[i]

    lists.sorted = Spy()
    (_, ids, scores), = lists.top(np.array([[1.0, 0, 0, 0]]), np.array([-1]), 3)
    assert ids.tolist() == [3999, 3998, 3997] and len(seen) == 2
