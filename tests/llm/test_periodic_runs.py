"""Runs against a search of all periods at all places."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearwell.llm import periodic_runs as pr
from clearwell.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Stretches of every period, the longest way round: a run must not have a smaller period as well."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            smaller = any(all(run[x] == run[x + d] for x in range(len(run) - d)) for d in range(1, q))
            if len(run) >= max(6, 4 * q) and not smaller:
                out.append((i, len(run), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_text(r):
    parts = []
    for _ in range(r.randrange(1, 6)):
        unit = [r.choice("abc") for _ in range(r.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16]))]
        parts += (unit * 9)[: r.randrange(1, len(unit) * 9)]
        parts += [r.choice("abcdefgh") for _ in range(r.randrange(4))]
    return " ".join(parts)


def test_random_texts_against_brute_force():
    r = random.Random(7)
    texts = [random_text(r) for _ in range(600)] + [None, "", " \t\n", "a", "a a a a a", "a a a a a a"]
    for text, (n, runs, kept) in zip(texts, pr._analysed(texts), strict=True):
        words = WORD.findall(text or "")
        assert n == len(words) and runs == brute(words) and kept == collapsed(words, runs)


@pytest.mark.parametrize("together", [1, 50, 1 << 17])
def test_documents_handled_together_do_not_meet(monkeypatch, together):
    monkeypatch.setattr(pr, "TOGETHER", together)
    texts = ["x x x", "x x x x", "a b", "a b a b a b", "a b a b a b a b"] * 3
    assert [runs for _, runs, _ in pr._analysed(texts)] == [[], [], [], [], [(0, 8, 2)]] * 3


def test_long_documents_take_linear_numbers_of_steps():
    # One run over everything, runs of a great period, and very many short runs.
    long = ["w"] * 300_000
    wide = [str(i) for i in range(20_000)] * 5
    many = (["a"] * 6 + ["b", "c"]) * 20_000
    results = [list(pr._analysed([" ".join(words)])) for words in (long, wide, many)]
    assert results[0][0][1] == [(0, 300_000, 1)] and results[0][0][2] == "w"
    assert results[1][0][1] == [(0, 100_000, 20_000)] and len(results[1][0][2].split()) == 20_000
    assert len(results[2][0][1]) == 20_001 and (0, 160_000, 8) in results[2][0][1]


def test_all_periods_of_one_class_and_exact_limits():
    for q in range(1, 70):
        unit = [f"{q}-{i}" for i in range(q)]
        least = max(6, 4 * q)
        words = ["x", *(unit * 7)[:least], "y", "y"]
        assert list(pr._analysed([" ".join(words)]))[0][1] == [(1, least, q)]
        words = ["x", *(unit * 7)[: least - 1], "y", "z"]
        assert list(pr._analysed([" ".join(words)]))[0][1] == []


def test_rows_of_any_kind(documents):
    rows = [(1, "a b " * 4), (1, "a b " * 4), (None, None), (2, ""), (3, "Go go " * 8), (4, "x x " * 6)]
    got = pr.periodic_runs(documents(rows))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    plain = sorted(((x.doc_id, x.n_words, [tuple(r) for r in x.runs], x.collapsed) for x in got.collect()), key=repr)
    assert plain == sorted(
        [
            (1, 8, [(0, 8, 2)], "a b"), (1, 8, [(0, 8, 2)], "a b"), (None, 0, [], ""), (2, 0, [], ""),
            (3, 16, [(0, 16, 2)], "Go go"), (4, 6, [(0, 6, 1)], "x x"),
        ], key=repr)
    assert pr.periodic_runs(documents([])).collect() == []
    named = documents(rows[:1]).withColumn("doc_id", F.lit("one"))
    assert pr.periodic_runs(named).first()[0] == "one"


def test_query_against_brute_force(llm, tmp_path):
    r = random.Random(11)
    rows = [(i, random_text(r)) for i in range(240)] + [(None, "b " * 9), (500, None), (501, " ")]
    llm.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: tuple(x)[1:] for x in QUERIES["op13_periodic_runs"](llm, str(tmp_path)).collect()}
    planted = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        wanted = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(words, runs)))
        assert got[doc_id] == (*wanted, *digests)
    assert planted > 10 and len(got) == len(rows)


def test_extension_stops_at_either_end():
    words = np.array([1, 1, 1, 2, 1, 1, 1], dtype=np.uint64)
    assert pr._agreeing(words, 0, 1, 1) == 2 and pr._agreeing(words, 1, 1, -1) == 2
    assert pr._agreeing(words, 0, 4, 1) == 3 and pr._agreeing(words, -1, 1, -1) == 0
