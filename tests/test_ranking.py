from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clearwell.operators import ranking


def brute_force(data, key):
    ranks, seen = {}, {}
    for row in sorted(data, key=key):
        seen[row[0]] = seen.get(row[0], 0) + 1
        ranks[row] = seen[row[0]]
    return ranks


def descending(row):
    group, value, tie = row
    return (group is None, group or "", value is None, -(value or 0.0), tie)


@pytest.fixture(scope="module")
def skewed():
    """One group with half of all rows, one value with a third of them, unknown groups and values."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        group = rng.choice(["hot"] * 5 + ["a", "b", "c", "d", None])
        value = rng.choice([7.0, None, round(rng.uniform(-50, 50), 2)])
        data.append((group, value, i))
    return data


def test_ranks_over_many_slices_equal_brute_force(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, v double, i int").repartition(7)
    ranked = ranking.rank_by_value(df, "g", "v", ["i"])
    got = {(r.g, r.v, r.i): r.row_num for r in ranked.collect()}
    assert got == brute_force(skewed, descending)


def test_hot_group_is_spread_over_slices(spark, skewed, monkeypatch):
    staged = []
    stage = ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    # Slices this small are merged by default; at scale they are not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame(skewed, "g string, v double, i int").repartition(7)
        ranked = ranking.rank_by_value(df, "g", "v", ["i"])
        slices = staged[0].filter("g = 'hot' AND v = 7.0").select("__slice").distinct().count()
        got = {(r.g, r.v, r.i): r.row_num for r in ranked.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert slices > 1
    assert got == brute_force(skewed, descending)


def test_start_table_too_large_to_broadcast_is_shuffled(spark, skewed, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_BYTES", -1)
    df = spark.createDataFrame(skewed, "g string, v double, i int")
    ranked = ranking.rank_by_value(df, "g", "v", ["i"])
    got = {(r.g, r.v, r.i): r.row_num for r in ranked.collect()}
    assert got == brute_force(skewed, descending)


def test_no_group_is_sorted_by_one_task_however_few_its_rows(spark, skewed, plan_of):
    df = spark.createDataFrame(skewed, "g string, v double, i int")
    for distinct in (False, True):
        ranked = ranking.rank_by_value(df, "g", "v", ["i"], distinct=distinct)
        assert "Window" not in plan_of(ranked)
        assert {(r.g, r.v, r.i): r.row_num for r in ranked.collect()} == brute_force(skewed, descending)


@pytest.mark.parametrize("ties", [(), ("n",)])
def test_ties_are_numbered_alike_in_every_run_and_on_both_paths(spark, ties):
    data = [("a", 1.0, f"s{i}", i % 7) for i in range(300)]
    schema = "location_abbr string, data_value double, s string, n int"
    runs = [
        ranking.rank_by_value(spark.createDataFrame(rows, schema).repartition(parts), ties=ties, distinct=bound)
        for rows, parts, bound in ((data, 3, False), (data[::-1], 5, False), (data, 2, True))
    ]
    first, *others = [sorted(map(tuple, r.collect())) for r in runs]
    assert sorted(r[-1] for r in first) == list(range(1, 301))
    assert all(o == first for o in others)


def test_text_metric_is_refused(spark):
    df = spark.createDataFrame([("a", "9"), ("a", "10")], "location_abbr string, data_value string")
    with pytest.raises(TypeError):
        ranking.rank_by_value(df)


def test_rows_equal_in_all_columns_still_get_different_numbers(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5, "location_abbr string, data_value double")
    assert sorted(r.row_num for r in ranking.rank_by_value(df).collect()) == [1, 2, 3, 4, 5]


def test_top_k_limits_before_the_shuffle(spark, skewed, plan_of):
    df = spark.createDataFrame(skewed, "g string, v double, i int")
    best = ranking.top_k(df, 3, "g", "v", ["i"])
    expected = {r: n for r, n in brute_force(skewed, descending).items() if n <= 3}
    assert {(r.g, r.v, r.i): r.row_num for r in best.collect()} == expected
    plan = plan_of(best)
    assert plan.count("WindowGroupLimit") >= 2


def test_numbering_without_a_group(spark):
    numbered = ranking.number_rows(spark.range(1000).repartition(6), [], [F.col("id").desc()], "n")
    assert all(r.n == 1000 - r.id for r in numbered.collect())


def test_empty_input(spark):
    df = spark.createDataFrame([], "location_abbr string, data_value double")
    assert ranking.rank_by_value(df).collect() == []


def test_copies_of_a_frequent_row_are_numbered_and_spread(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PORTION_ROWS", 50)
    data = [("a", 1.0, "x")] * 1037 + [("a", 1.0, "y")] * 100 + [("a", 2.0, "x")] * 3 + [(None, None, None)] * 2
    df = spark.createDataFrame(data, "location_abbr string, data_value double, s string").repartition(5)
    numbered = ranking.rank_by_value(df, ties=["s"])
    tasks = numbered.select("data_value", "s", F.spark_partition_id().alias("task"))
    assert len({r.task for r in tasks.collect() if (r.data_value, r.s) == (1.0, "x")}) > 1
    ranked = numbered.collect()
    assert len(ranked) == len(data)
    got = {}
    for row in ranked:
        got.setdefault((row.data_value, row.s), []).append(row.row_num)
    assert sorted(got[(2.0, "x")]) == [1, 2, 3]
    assert sorted(got[(1.0, "x")]) == list(range(4, 1041)) and sorted(got[(1.0, "y")]) == list(range(1041, 1141))
    assert sorted(got[(None, None)]) == [1, 2]
