"""Passages against edit distances at every word, and the recall at the limit."""

from __future__ import annotations

import pickle
import random

import numpy as np
import pytest

from clearwell.llm import decontamination as dc
from clearwell.llm.queries import QUERIES


def distance(item, words):
    """Smallest edit distance of the item from any run of words."""
    previous = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        current = [i]
        for j, y in enumerate(words, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return min(previous)


def by_brute_force(docs, items, similarity=0.8):
    out = {}
    for key, text in docs:
        words = dc.normalised_words(text)
        for item_id, item in items:
            item = dc.normalised_words(item)
            most = int(len(item) * (1 - similarity) + 1e-9)
            if len(item) >= 5 and (d := distance(item, words)) <= most:
                out[key, item_id] = d
    return out


@pytest.fixture
def benchmark(llm):
    def make(items):
        return llm.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS key", "2 AS doc_id")

    return make


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = r.randrange(3), r.randrange(len(words))
        if kind == 0:
            words[at] = f"new{r.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"new{r.randrange(10**6)}")
        else:
            del words[at]
    return words


def test_equal_and_edited_passages(documents, benchmark):
    r = random.Random(2)
    word = lambda: f"w{int(r.paretovariate(0.6)) % 3000}"
    items = [(i, " ".join(word() for _ in range(r.choice([8, 14, 25, 40, 90])))) for i in range(30)]
    docs = []
    for key in range(90):
        host = [word() for _ in range(r.randrange(300))]
        if key % 2:
            item = items[r.randrange(30)][1].split()
            at = r.randrange(len(host) + 1)
            host[at:at] = edited(r, item, r.choice([0, 0, 1, len(item) // 10]))
        docs.append((key, " ".join(host).upper() if key % 5 == 0 else " ".join(host)))
    wanted = by_brute_force(docs, items)
    got = {(r["doc_id"], r["item_id"]): r["distance"]
           for r in dc.contaminated(documents(docs), benchmark(items)).collect()}
    assert set(got) <= set(wanted)
    assert {pair for pair, d in wanted.items() if d == 0} <= set(got)
    assert len(got) >= 0.9 * len(wanted)
    assert all(got[p] == wanted[p] for p in got)


@pytest.mark.parametrize("words", [5, 12, 20, 40, 60, 100, 200])
def test_recall_at_the_limit_wherever_the_edits_are(words):
    r = random.Random(words)
    items = [[f"w{int(r.paretovariate(0.5)) % 4000}" for _ in range(words)] for _ in range(12)]
    finder = dc.Finder(list(range(12)), items, 0.8, 0.95, 5)
    for place in dc.PLACES:
        found = 0
        for i in range(96):
            passage = dc._edited(finder.items[i % 12], finder.most[i % 12], place, r)
            names = {n: w for w, n in finder.number.items() if isinstance(w, str)}
            text = " ".join([f"x{r.randrange(99)}" for _ in range(30)] + [names.get(n, "other") for n in passage] + ["end"])
            found += any(hit[1] == i % 12 for hit in finder.find([text]))
        assert found >= 0.93 * 96, place


def test_a_recall_out_of_reach_is_an_error(monkeypatch):
    monkeypatch.setattr(dc, "MOST_REPETITIONS", 1)
    with pytest.raises(ValueError, match="do not reach"):
        dc.Finder([1], [[f"w{i}" for i in range(40)]], 0.6, 0.99, 5)


def test_the_index_grows_with_the_words_of_the_items():
    size = lambda n: len(pickle.dumps(dc.Finder(list(range(n)), [
        [f"w{i * 13 + j}" for j in range(20)] for i in range(n)], 0.9, 0.9, 5)))
    assert size(200) < 5 * size(50)


def test_bit_parallel_distances_equal_the_table():
    r = random.Random(9)
    for _ in range(300):
        item = [r.randrange(2, 8) for _ in range(r.randrange(1, 90))]
        window = [r.randrange(0, 8) for _ in range(r.randrange(0, 120))]
        assert min(dc._distances(item, window, True)) == distance(item, window)
        found = dc.best_passage(item, window, len(item))
        part = window[found[1] : found[1] + found[2]]
        assert dc._distances(item, part, False)[-1] == found[0] == distance(item, window)


def test_rare_words_leave_every_window_of_a_passage():
    r = random.Random(4)
    items = [[f"w{int(r.paretovariate(0.4)) % 300}" for _ in range(r.randrange(12, 40))] for _ in range(20)]
    finder = dc.Finder(list(range(20)), items, 0.8, 0.9, 5)
    frequency = np.array([r.randrange(99) for _ in range(finder.size)])
    for of in finder.classes:
        for extra in (0.05, 0.5, 0.8):
            rare = finder._rare(of, frequency, extra)
            for i in of.items * 5:
                passage = dc._edited(finder.items[i], finder.most[i], r.choice(dc.PLACES), r)
                text = np.array([0] * 9 + passage + [0] * 9 + [1])
                assert 9 in finder._windows(of, rare, text)


def test_long_documents_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(dc, "PIECE", 64)
    item = [f"w{i}" for i in range(20)]
    finder = dc.Finder([5], [item], 0.8, 0.95, 5)
    for at in (0, 40, 55, 63, 64, 100, 190):
        words = [f"x{i}" for i in range(200)]
        words[at:at] = item
        assert [h[1:4] for h in finder.find([None, " ".join(words), ""])] == [(0, 0, at)]


def test_hostile_rows(documents, benchmark):
    item = "one two three four five six seven eight"
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (5, "!!!"), (None, item)]
    docs = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "Too, short!"), (5, "far too short"), (6, "?" * 99)]
    rows = dc.contaminated(documents(docs), benchmark(items)).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in rows}
    assert pairs == {(1, 1), (1, None), (None, 1), (None, None), (4, 4)}
    assert dc.contaminated(documents([]), benchmark(items)).count() == 0
    assert dc.contaminated(documents(docs), benchmark([])).count() == 0
    kept = dc.remove(documents(docs), benchmark(items))
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [2, 3, 5, 6]
    assert kept.columns == documents([]).columns


def test_walks_stop_at_the_end_of_a_document():
    assert all(dc._bits(9, repetition)[1] == 0 for repetition in range(5))


@pytest.mark.parametrize("text", ["It's a_b C3PO--x", "ÄB c", "", None, "\x00a\x7fb"])
def test_ascii_words_are_split_alike(text):
    split = [w.decode() if isinstance(w, bytes) else w for w in dc._split(text)]
    assert split == dc.normalised_words(text)


def test_query_finds_every_equal_passage(llm):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in llm.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in llm.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    short = [(k, t) for k, t in docs if len(t) < 2500]
    wanted = by_brute_force(short, items)
    keys = {k for k, _ in short}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontaminate"](llm, folder).collect() if r["doc_id"] in keys}
    assert got <= set(wanted) and {p for p, d in wanted.items() if d == 0} <= got


def test_items_in_scripts_without_blanks_and_without_an_id(documents, llm):
    chinese, english = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed", "one passage that has no id but is in the benchmark"
    benchmark = llm.createDataFrame([(7, chinese), (None, english)], "item_id long, text string")
    df = documents([(1, "\u6211\u8bf4" + chinese + "\u5427"), (2, f"before {english} after"), (3, "\u6211\u4eec\u53bb\u516c\u56ed\u73a9")])
    found = dc.contaminated(df, benchmark, similarity=0.8, recall=0.95).collect()
    got = sorted((r["doc_id"], r["item_id"], r["distance"], r["first_word"]) for r in found)
    assert got == [(1, 7, 0, 2), (2, None, 0, 1)]
    assert [r["doc_id"] for r in dc.remove(df, benchmark, similarity=0.8, recall=0.95).collect()] == [3]


def test_remove_sends_python_few_texts_in_one_worker_a_task(documents, benchmark, monkeypatch):
    name, met, whole = "spark.sql.execution.arrow.maxRecordsPerBatch", [], dc.stage
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(dc, "ITEMS_PER_PASS", 1)
    monkeypatch.setattr(dc, "stage", lambda df, label: met.append((int(df.sparkSession.conf.get(name)), plan(df))) or whole(df, label))
    items = [(1, "one two three four five six"), (2, "seven eight nine ten eleven twelve")]
    rows = [(1, f"a {items[0][1]} b"), (2, "other words that are here"), (3, f"c {items[1][1]}"), (3, None), (None, "x"), (None, items[1][1])]
    df = documents(rows + rows)
    before = df.sparkSession.conf.get(name)
    kept = dc.remove(df, benchmark(items))
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(2, rows[1][1]), (3, None), (None, "x")] * 2, key=str)
    assert [size for size, p in met if "MapInArrow" in p] == [dc.TEXTS] * 2 and df.sparkSession.conf.get(name) == before
    assert all(p.count("MapInArrow") <= 1 for _, p in met) and "MapInArrow" not in plan(kept)
