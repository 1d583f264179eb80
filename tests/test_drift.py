from __future__ import annotations

import json
from datetime import datetime

import pytest

from clearwell.operators import checks as ck, drift, suites

HISTORY = "dataset string, run_ts string, row_count long, null_rate double"


def compared(spark, *runs, **options):
    return drift.compare_runs(spark.createDataFrame(list(runs), HISTORY), **options)


@pytest.mark.parametrize(
    "before, after, alarm",
    [(100, 91, False), (100, 90, False), (100, 89, True), (100, 0, True), (100, 200, False), (0, 5, False)],
)
def test_volume_alarm(spark, before, after, alarm):
    runs = compared(spark, ("d", "1", before, 0.0), ("d", "2", after, 0.0)).orderBy("run_ts").collect()
    assert [r.volume_alarm for r in runs] == [False, alarm]


@pytest.mark.parametrize(
    "before, after, alarm",
    [(0.0, 0.05, False), (0.0, 0.06, True), (0.3, 0.1, False), (None, 0.9, False), (0.1, None, False)],
)
def test_null_rate_alarm(spark, before, after, alarm):
    runs = compared(spark, ("d", "1", 5, before), ("d", "2", 5, after)).orderBy("run_ts").collect()
    assert [r.null_rate_alarm for r in runs] == [False, alarm]


def test_datasets_do_not_mix_and_only_the_newest_pair_may_be_asked_for(spark):
    runs = [("a", "1", 100, 0.0), ("a", "2", 50, 0.0), ("a", "3", 50, 0.0), ("b", "2", 10, 0.0)]
    full = {(r.dataset, r.run_ts): r.volume_alarm for r in compared(spark, *runs).collect()}
    assert full == {("a", "1"): False, ("a", "2"): True, ("a", "3"): False, ("b", "2"): False}
    newest = compared(spark, *runs, newest_only=True)
    assert {(r.dataset, r.run_ts, r.prev_row_count) for r in newest.collect()} == {("a", "3", 50), ("b", "2", None)}


def test_enforce_names_every_alarm(spark):
    runs = compared(spark, ("d", "1", 100, 0.0), ("d", "2", 50, 0.5))
    with pytest.raises(drift.DriftDetected, match=r"(?s)50.0% drop \(100 to 50\).*0.0% to 50.0%"):
        drift.enforce_no_drift(runs)
    drift.enforce_no_drift(compared(spark, ("d", "1", 100, 0.0)))


def test_history_comes_from_check_results(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (None,)], "data_value double")
    checks = [ck.RowCountBetween(None, 1, 9), ck.ValuesNotNull("data_value")]
    results = suites.run_suite(df, checks, "d", datetime(2024, 1, 1))
    row = drift.run_history(results).first()
    assert (row.dataset, row.run_ts, row.row_count, row.null_rate) == ("d", datetime(2024, 1, 1), 4, 0.5)


def test_nested_report_files_feed_the_same_comparison(spark, tmp_path):
    def report(rows, percent):
        return {
            "success": True,
            "results": [
                {
                    "success": True,
                    "expectation_config": {"type": "expect_table_row_count_to_be_between",
                                           "kwargs": {"min_value": 1}},
                    "result": {"observed_value": rows},
                },
                {
                    "success": True,
                    "expectation_config": {"type": "expect_column_values_to_not_be_null",
                                           "kwargs": {"column": "data_value"}},
                    "result": {"unexpected_count": 1, "unexpected_percent": percent},
                },
            ],
        }

    for name, content in {
        "gx_nutri_cleaned_20240131_080000.json": report(100, 1.0),
        "gx_nutri_cleaned_20240201_080000.json": report(80, 9.0),
    }.items():
        (tmp_path / name).write_text(json.dumps(content, indent=2))
    history = drift.run_history(suites.read_nested_reports(spark, str(tmp_path)))
    latest = drift.compare_runs(history, newest_only=True).first()
    assert latest.dataset == "nutri_cleaned" and latest.run_ts == datetime(2024, 2, 1, 8)
    assert latest.volume_alarm and latest.null_rate_alarm
    assert (latest.prev_row_count, latest.row_count) == (100, 80)


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    assert tuple(drift.null_rates(df, "a", "b").first()) == (0.25, 0.5)


def test_baseline_tolerance_is_two_sided_and_strict(spark):
    baselines = spark.createDataFrame(
        [("same", 100), ("edge", 100), ("above", 100), ("near", 100), ("gone", 100)], "dataset string, baseline long"
    )
    counts = spark.createDataFrame(
        [("same", 100), ("edge", 90), ("above", 111), ("near", 91)], "dataset string, row_count long"
    )
    stable = {r.dataset: r.stable for r in drift.within_baseline(counts, baselines).collect()}
    assert stable == {"same": True, "edge": False, "above": False, "near": True, "gone": False}
