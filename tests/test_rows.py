from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clearwell.operators import keyvalue, rows as ops


def test_exclude_codes_also_drops_unknown_codes(spark, rows):
    df = spark.createDataFrame([("US",), ("AL",), (None,)], "c string")
    assert rows(ops.exclude_codes(df, "c", ["US", "PR"])) == [("AL",)]


def test_exclusion_reaches_the_scan(spark, plan_of):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(ops.exclude_codes(orders, "o_orderstatus", ["P"]))
    assert "Not(EqualTo(o_orderstatus,P))" in plan


def test_drop_missing_drops_null_and_nan_and_reaches_the_scan(spark, rows, plan_of):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "v double, k string")
    assert rows(ops.drop_missing(df, ["v", "k"])) == [(1.0, "a")]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert "IsNotNull(o_totalprice)" in plan_of(ops.drop_missing(orders, ["o_totalprice"]))


def test_metric_guard(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "m double")
    assert ops.require_metric(df, "m") is df
    with pytest.raises(ValueError):
        ops.require_metric(df, "other")
    with pytest.raises(ValueError):
        ops.require_metric(df.filter("m IS NULL"), "m")
    with pytest.raises(ValueError):
        ops.require_metric(df.limit(0), "m")


def test_dedupe_treats_null_as_equal(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, None)], "a int, b string")
    assert rows(ops.dedupe(df)) == sorted([(1, None), (1, "x"), (None, None)], key=repr)
    assert tuple(ops.duplicate_count(df).first()) == (4, 3, 1)
    assert tuple(ops.duplicate_count(df.limit(0)).first()) == (0, 0, 0)


def test_copies_are_merged_before_the_shuffle(spark, plan_of):
    plan = plan_of(ops.dedupe(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    final = plan.index("HashAggregate")
    shuffle = plan.index("Exchange", final)
    assert plan.index("HashAggregate", shuffle) < plan.index("Scan parquet")


def test_replace_values_matches_exactly_then_trims(spark):
    df = spark.createDataFrame([("per 100,000",), ("  cases per 100,000",), (" per 100,000",), (None,)], "u string")
    units = {"per 100,000": "cases per 100,000", "  cases per 100,000": "cases per 100,000"}
    got = [r.u for r in ops.replace_values(df, "u", units).collect()]
    assert got == ["cases per 100,000", "cases per 100,000", "per 100,000", None]


def test_levels_and_head(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert rows(ops.category_levels(df, "c")) == [("a",), ("b",)]
    head = ops.head_rows(spark.range(1000).selectExpr("999 - id AS id"), ["id"], 3)
    assert [r.id for r in head.collect()] == [0, 1, 2]


def test_head_keeps_n_rows_per_task(spark, plan_of):
    plan = plan_of(ops.head_rows(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), ["o_orderkey"]))
    assert "TakeOrderedAndProject" in plan


def test_items_leave_out_missing_attributes(spark):
    df = spark.createDataFrame(
        [
            ("AL", "2020", 1.5, "x"),
            ("AL", "2021", float("nan"), "nan"),
            (None, "2020", 1.0, "x"),
            ("AK", None, 1.0, "x"),
        ],
        "location_abbr string, year string, v double, t string",
    ).withColumn("d", F.lit("2024-01-31").cast("date"))
    made = keyvalue.items(df, ["location_abbr", "year"], whole=["year"])
    got = [json.loads(r.item) for r in made.orderBy("year").collect()]
    assert got == [
        {"location_abbr": "AL", "year": 2020, "v": 1.5, "t": "x", "d": "2024-01-31"},
        {"location_abbr": "AL", "year": 2021, "d": "2024-01-31"},
    ]


def test_batches_of_25(spark):
    numbered = keyvalue.batch_numbers(spark.range(60), ["id"])
    sizes = {r.batch_no: r["count"] for r in numbered.groupBy("batch_no").count().collect()}
    assert sizes == {0: 25, 1: 25, 2: 10}
    assert numbered.filter("id < 25").agg(F.max("batch_no")).first()[0] == 0
