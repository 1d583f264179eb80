"""Components against all pairs of plain sets of words."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from clearwell.llm import membership
from clearwell.llm import near_duplicates as nd
from clearwell.llm.graph import components
from clearwell.llm.queries import QUERIES


def sets_of(rows, width):
    out = []
    for key, text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        out.append((key, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()))
    return out


def by_all_pairs(rows, width, percent):
    sets = sets_of(rows, width)
    parent = {k: k for k, _ in sets if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted(((k, len(s), None if k is None else find(k)) for k, s in sets), key=repr)


def found(df, **options):
    rows = nd.near_duplicates(df, **options).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr)


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return words


@pytest.mark.parametrize("width", [2, 5])
def test_groups_equal_all_pairs(documents, width):
    r = random.Random(3)
    rows, key = [], 0
    for group in range(40):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 8, 30, 70, 150, 400]))]
        for _ in range(r.choice([1, 2, 3, 12])):
            rows.append((key := key + 1, " ".join(edited(r, base, r.choice([0, 1, len(base) // 12, len(base) // 20])))))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(key := key + 1, passage + " " + " ".join(f"q{r.randrange(10**6)}" for _ in range(n))) for n in range(40)]
    r.shuffle(rows)
    assert found(documents(rows), width=width) == by_all_pairs(rows, width, 80)


@pytest.mark.parametrize(("gathered", "block"), [(1, 16), (4, 16), (4, 1024), (64, 8)])
def test_lists_of_any_length_ask_the_same(documents, monkeypatch, gathered, block):
    monkeypatch.setattr(nd, "GATHERED", gathered)
    monkeypatch.setattr(nd, "BLOCK_ROWS", block)
    r = random.Random(6)
    rows = []
    for group in range(6):
        base = [f"w{r.randrange(300)}" for _ in range(120)]
        rows += [(100 * group + i, " ".join(edited(r, base, r.randrange(12)))) for i in range(20)]
    assert found(documents(rows), width=2) == by_all_pairs(rows, 2, 80)


def test_every_set_with_entries_has_one_home_among_them(documents):
    r = random.Random(7)
    bases = [[f"w{r.randrange(300)}" for _ in range(150)] for _ in range(10)]
    docs = documents([(i, " ".join(edited(r, bases[i % 10], i % 7))) for i in range(80)])
    nodes = nd._nodes(nd.sketches(docs, "doc_id", "text", 2, 128)).cache()
    entries = nd.index_entries(nodes, 128, 80).collect()
    homes = [(e["node"], e["home"]) for e in entries if e["value"] == e["home"]]
    assert sorted(n for n, _ in homes) == sorted({e["node"] for e in entries}) and len(homes) > 60
    assert set(homes) == {(e["node"], e["home"]) for e in entries}


def test_near_copies_share_few_homes_whatever_their_edits(documents, monkeypatch):
    r, asked, whole = random.Random(8), [], nd._asked_in_long
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(r, base, r.randrange(12)))) for i in range(400)]
    nodes = nd._nodes(nd.sketches(documents(rows), "doc_id", "text", 2, 128)).cache()
    homes = nd.index_entries(nodes, 128, 80).where("value = home").groupBy("home").count().collect()
    assert max(h["count"] for h in homes) > sum(h["count"] for h in homes) / 2
    monkeypatch.setattr(nd, "_asked_in_long", lambda *of: asked.append(nd.stage(whole(*of), "asked")) or asked[0])
    assert found(documents(rows), width=2) == by_all_pairs(rows, 2, 80)
    # Homes times lists times members asked; about as many homes as edits gave more than a million rows for 2500 copies.
    assert asked[0].count() < 40 * len(rows)


def test_short_lists_are_shuffled_once(llm):
    entries = llm.createDataFrame([], "value long, node long, n_shingles long, home long, component long, large boolean")
    plan = nd._asked_in_short(entries, 80)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_texts_go_to_python_in_small_batches(documents, monkeypatch):
    name, met, whole = "spark.sql.execution.arrow.maxRecordsPerBatch", [], nd.sketches
    docs = documents([(1, "a b c"), (2, "a b c d")])
    before = docs.sparkSession.conf.get(name)
    monkeypatch.setattr(nd, "sketches", lambda df, *of: met.append(int(df.sparkSession.conf.get(name))) or whole(df, *of))
    assert len(found(docs)) == 2
    assert met == [nd.TEXTS] and docs.sparkSession.conf.get(name) == before


def test_homes_larger_than_a_block(documents, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 16)
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(r, base, r.randrange(14)))) for i in range(150)]
    assert found(documents(rows), width=2) == by_all_pairs(rows, 2, 80)


def test_hostile_rows(documents):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(1, "A b c"), (1, "A b c"), (2, "a  B\tC"), (3, None), (4, ""), (5, " \n "), (6, "a"), (7, "A"),
            (None, "a b c"), (8, long), (9, long + " x"), (10, "� é"), (11, "É é")]
    assert found(documents(rows), width=2) == by_all_pairs(rows, 2, 80)


def test_empty_table(documents):
    assert found(documents([])) == []


def test_deduplicate_keeps_one_of_each_group_and_all_columns(documents):
    text = " ".join(f"w{i}" for i in range(50))
    df = documents([(3, text), (1, text), (1, text), (2, "other words here"), (None, text), (4, None), (5, None)])
    kept = nd.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 4, 5, None]


def test_components_of_paths_stars_and_loops(llm):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 100)]
    got = {r["node"]: r["component"] for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in [*range(100, 130), 200]}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_all_pairs(llm):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in llm.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op10_near_duplicates"](llm, folder).collect()]
    assert sorted(got, key=repr) == by_all_pairs(rows, 2, 80)


def test_levels_keep_the_order_of_counts():
    counts = np.concatenate([np.arange(1 << 12), 1 << np.arange(12, 40)])
    levels = nd._level(counts).astype(int)
    assert levels[:4].tolist() == [0, 1, 2, 3] and levels.max() == 15
    assert (np.diff(levels) >= 0).all()


def test_bitmaps_grow_with_the_keys_up_to_a_bound():
    assert [membership._bits(n) for n in (0, 1000, 1 << 20, 10**12)] == [18, 18, 25, 28]


def test_likely_members_have_all_members_and_lose_no_row(documents):
    df = documents([(i, f"t{i}") for i in range(2000)] + [(None, "none")])
    likely, others = membership.likely_members(df, "doc_id", df.where("doc_id % 7 = 0").select("doc_id"))
    found = {r["doc_id"] for r in likely.collect()}
    assert {i for i in range(2000) if i % 7 == 0} <= found and None not in found
    assert likely.count() + others.count() == 2001
