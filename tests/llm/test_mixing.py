"""Mixing against its SQL, and on cases that are easy to get wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clearwell.llm import mixing
from clearwell.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, duck


def water_fill(caps_and_weights, budget):
    """Round after round, as one would by hand."""
    targets, clamped = {}, set()
    while True:
        free = {k: w for k, (c, w) in caps_and_weights.items() if k not in clamped}
        left = budget - sum(caps_and_weights[k][0] for k in clamped)
        targets = {k: caps_and_weights[k][0] for k in clamped}
        targets |= {k: left * w / sum(free.values()) for k, w in free.items()}
        over = {k for k in free if targets[k] > caps_and_weights[k][0]}
        if not over:
            return targets
        clamped |= over


@pytest.mark.parametrize("totals", [[10, 10, 10], [100, 1, 1, 1], [1, 50, 3, 70, 9, 2, 2, 400], [5], [0, 7, 0]])
def test_targets_equal_repeated_clamping(llm, totals):
    rows = [(f"s{i}", n) for i, n in enumerate(totals)]
    weighted = mixing.cyclic_weights(llm.createDataFrame(rows, "source string, total long"), (3, 1, 2))
    found = {r["source"]: r["target"] for r in mixing.water_fill(weighted, 1.5, 2.0).collect()}
    caps = {s: (2.0 * n, float((3, 1, 2)[i % 3])) for i, (s, n) in enumerate(rows)}
    assert found == pytest.approx(water_fill(caps, min(1.5 * sum(totals), 2.0 * sum(totals))))


def test_weights_that_are_null_or_not_positive_take_nothing(llm):
    rows = [("a", 10, 1.0), ("b", 10, 0.0), ("c", 10, None), ("d", 10, -1.0)]
    df = llm.createDataFrame(rows, "source string, total long, weight double")
    assert {r["source"]: r["target"] for r in mixing.water_fill(df, 1.5, 2.0).collect()} == {
        "a": 20.0, "b": 0.0, "c": 0.0, "d": 0.0,
    }


def test_hostile_rows(documents):
    words = "one two three four five"
    rows = [(1, words, "en", "a"), (1, words, "en", "a"), (2, None, "en", "a"), (3, "", None, None),
            (None, words, None, None), (4, "word " * 5000, "en", "ä"), (5, words, "en", "a")]
    df = documents(rows)
    mixed = mixing.mix_sources(df)
    assert mixed.columns == df.columns
    sized = mixing.sized_documents(df, 42)
    taken = mixing.mixed_sizes(sized, mixing.plan_mix(sized.drop("key"))).collect()
    assert len(taken) == len(rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in taken)
    copies = sum(r["copies"] for r in taken)
    assert mixed.count() == copies
    # The same draws again.
    assert sorted(map(tuple, mixed.select("doc_id", "text").collect()), key=repr) == sorted(
        map(tuple, mixing.mix_sources(df).select("doc_id", "text").collect()), key=repr
    )


@pytest.mark.parametrize("text", [lambda i: f"{i} " + "word " * 99, lambda i: "word " * 100])
def test_rows_without_an_id_and_repeated_rows_are_drawn_one_by_one(documents, text):
    rows = [(None, text(i), "en", "a") for i in range(50)] + [(7, text(i), "en", "a") for i in range(50)]
    rows += [(i, "other words " * 5, "en", "b") for i in range(100, 400)]
    df = documents(rows)
    sized = mixing.sized_documents(df, 42)
    taken = mixing.mixed_sizes(sized, mixing.plan_mix(sized.drop("key"), cycle=(1, 9)))
    totals = taken.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 100 for r in totals)
    mixed = mixing.mix_sources(df, cycle=(1, 9))
    assert mixed.count() == taken.agg(F.sum("copies")).first()[0]


def test_empty_table(documents):
    assert mixing.mix_sources(documents([])).count() == 0


def test_sources_come_near_their_targets(llm):
    rows = QUERIES["op1_mix"](llm, "/root/testdata/sf0.1").join(
        llm.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    per_source = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.02 * r["target"] for r in per_source)


def test_no_python_in_the_plan(llm, plan_of):
    plan = plan_of(QUERIES["op1_mix"](llm, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op1_mix", "op7_licences", "op8_top_k"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(llm, name, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(QUERIES[name](llm, folder), duck(folder), ORACLES[name]) is None
