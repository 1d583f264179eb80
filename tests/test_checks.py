from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clearwell.operators import checks as ck, suites, yaml_checks
from clearwell.sources import scan

DATA = [
    ("AL", 2011, 10.0, 9.0, 11.0, "k1"),
    ("al", 2025, -1.0, 5.0, 4.0, "k2"),
    ("ALA", 2000, None, None, 1.0, "k2"),
    (None, None, 50.0, 0.0, 0.0, None),
]
COLUMNS = "code string, year int, v double, low double, high double, k string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, COLUMNS)


def result(df, check):
    row = suites.run_suite(df, [check], "d").first()
    return row.success, row.unexpected_count, round(row.unexpected_pct, 4)


@pytest.mark.parametrize(
    "check, expected",
    [
        (ck.RowCountBetween(None, 4, 4), (True, 0, 0.0)),
        (ck.RowCountBetween(None, 5, 9), (False, 0, 0.0)),
        (ck.ColumnCount(None, 6), (True, 0, 0.0)),
        (ck.ColumnCount(None, 7), (False, 0, 0.0)),
        (ck.ColumnExists("v"), (True, 0, 0.0)),
        (ck.ColumnExists("w"), (False, 0, 0.0)),
        (ck.ValuesBetween("year", 2000, 2025), (True, 0, 0.0)),
        (ck.ValuesBetween("year", 2001, 2024), (False, 2, 66.6667)),
        (ck.ValuesBetween("year", None, 2024), (False, 1, 33.3333)),
        (ck.ValuesInSet("code", ("AL", "al", "ALA")), (True, 0, 0.0)),
        (ck.ValuesInSet("code", ("AL",)), (False, 2, 66.6667)),
        (ck.ValuesMatch("code", "^[A-Z]{2}$"), (False, 2, 66.6667)),
        (ck.ValuesMatch("k", "^k[0-9]$"), (True, 0, 0.0)),
        (ck.ValuesNotNull("v"), (False, 1, 25.0)),
        (ck.MissingCountZero("high"), (True, 0, 0.0)),
        (ck.ValuesUnique("code"), (True, 0, 0.0)),
        (ck.ValuesUnique("k"), (False, 2, 66.6667)),
        (ck.InvalidCountZero("v", 0), (False, 1, 33.3333)),
        (ck.InvalidCountZero("v", -1, 50), (True, 0, 0.0)),
        (ck.InvalidCountZero("code", length=2), (False, 1, 33.3333)),
        (ck.NoFailedRows("interval", "low > high"), (False, 1, 25.0)),
        (ck.NoFailedRows("interval", "v > 100"), (True, 0, 0.0)),
    ],
)
def test_single_checks(df, check, expected):
    assert result(df, check) == expected


def test_flag_check(df):
    flagged = df.withColumn("ok", F.coalesce(F.col("low") <= F.col("high"), F.lit(False)))
    assert result(flagged, ck.TrueFlag("ok")) == (False, 2, 50.0)
    assert result(flagged.filter("ok"), ck.TrueFlag("ok")) == (True, 0, 0.0)


def test_checks_on_absent_columns_fail_or_are_left_out(df):
    checks = [ck.ValuesNotNull("absent"), ck.ValuesUnique("absent"), ck.ValuesNotNull("high")]
    kept = suites.run_suite(df, checks, "d").collect()
    assert [(r.column, r.success, r.unexpected_count) for r in kept] == [
        ("absent", False, None), ("absent", False, None), ("high", True, 0),
    ]
    assert [r.column for r in suites.run_suite(df, checks, "d", skip_absent=True).collect()] == ["high"]
    nothing = suites.run_suite(df, checks[:1], "d", skip_absent=True)
    assert nothing.collect() == [] and nothing.schema == suites.RESULT_SCHEMA


def test_empty_table_passes_value_checks(df):
    empty = df.limit(0)
    checks = [ck.ValuesBetween("year", 0, 1), ck.ValuesUnique("k"), ck.RowCountBetween(None, 1, 2)]
    rows = suites.run_suite(empty, checks, "d").collect()
    assert {r.expectation: r.success for r in rows} == {
        ck.ValuesBetween.kind: True, ck.ValuesUnique.kind: True, ck.RowCountBetween.kind: False,
    }


def test_unique_check_counts_a_hot_value(spark):
    hot = spark.range(30000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS k")
    assert result(hot, ck.ValuesUnique("k")) == (False, 10000, 33.3333)


def test_a_suite_is_one_aggregate_without_python(df, spark, plan_of):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    checks = [ck.RowCountBetween(None, 0, 9), ck.ValuesNotNull("l_tax"), ck.ValuesBetween("l_tax", 0, 1)]
    plan = plan_of(suites.run_suite(lines, checks, "d"))
    assert plan.count("Scan parquet") == plan[plan.index("(1)"):].count("Scan parquet") * 2
    assert "ReadSchema: struct<l_tax:double>" in plan
    assert "Python" not in plan and plan.count("SinglePartition") == 1


def test_results_of_all_datasets_and_their_summary(df):
    batches = {
        "good": (df, [ck.ValuesNotNull("high"), ck.ColumnExists("v")]),
        "bad": (df, [ck.ValuesNotNull("v"), ck.ColumnExists("v"), ck.ValuesUnique("k")]),
    }
    moment = datetime(2024, 1, 31, 12)
    results = suites.run_suites(batches, moment)
    assert {r.run_ts for r in results.collect()} == {moment}
    summary = {r.dataset: (r.total, r.successful, r.failed, r.success) for r in suites.summarise(results).collect()}
    assert summary == {"good": (2, 2, 0, True), "bad": (3, 1, 2, False)}
    verdicts = {(r.dataset, r.overall_pass) for r in suites.with_overall_pass(results).collect()}
    assert verdicts == {("good", True), ("bad", False)}
    with pytest.raises(suites.ChecksFailed, match="bad: .*unique.k"):
        suites.enforce(results)
    good = results.filter("dataset = 'good'")
    assert suites.enforce(good) is good


def test_learned_ranges_apply_to_a_later_batch(df):
    baseline = df.filter("year < 2020")
    checks = ck.learn_ranges(baseline, ["year", "v", "absent"])
    assert checks == [ck.ValuesBetween("year", 2000, 2011), ck.ValuesBetween("v", 10.0, 10.0)]
    outcome = {r.column: r.unexpected_count for r in suites.run_suite(df, checks, "d").collect()}
    assert outcome == {"year": 1, "v": 2}
    assert all(r.success for r in suites.run_suite(baseline, checks, "d").collect())


def test_failed_rows(df):
    assert [r.code for r in ck.failed_rows(df, "low > high").collect()] == ["al"]


def test_reports_round_trip(df, spark, tmp_path):
    folder = str(tmp_path / "reports")
    for hour in (1, 2):
        results = suites.run_suite(df, [ck.ValuesNotNull("v"), ck.RowCountBetween(None, 1, 9)], "d",
                                   datetime(2024, 1, 1, hour))
        suites.write_reports(results, folder)
    back = suites.read_reports(spark, folder)
    assert back.schema.names == suites.RESULT_SCHEMA.names
    assert back.count() == 4
    assert {(r.expectation, r.observed, r.unexpected_pct) for r in back.collect()} == {
        ("expect_column_values_to_not_be_null", None, 25.0),
        ("expect_table_row_count_to_be_between", 4.0, 0.0),
    }


def test_nested_documents_read_back_as_the_same_results(df, spark, tmp_path):
    checks = [ck.ValuesNotNull("v"), ck.RowCountBetween(None, 1, 9), ck.ValuesUnique("k")]
    results = suites.run_suite(df, checks, "d", datetime(2024, 1, 31, 8))
    (document,) = suites.as_documents(results).collect()
    (tmp_path / "gx_d_20240131_080000.json").write_text(document.document)
    back = suites.read_nested_reports(spark, str(tmp_path))
    assert back.exceptAll(results).count() == 0 and results.exceptAll(back).count() == 0


def test_validate_keeps_reports_and_reads_the_tables_once(df, spark, tmp_path, plan_of):
    folder = str(tmp_path / "kept")
    batches = {"d": (df, [ck.ValuesNotNull("v"), ck.ValuesUnique("k")])}
    for hour in (1, 2):
        results = suites.validate(spark, batches, folder, datetime(2024, 1, 1, hour))
        assert {(r.run_ts, r.success) for r in results.collect()} == {(datetime(2024, 1, 1, hour), False)}
    assert suites.read_reports(spark, folder).count() == 4
    assert suites.validate(spark, batches, folder).count() == 2
    plan = plan_of(suites.summarise(results))
    assert "json" in plan and "LocalTableScan" not in plan
    with pytest.raises(suites.ChecksFailed):
        suites.enforce(results)


YAML = """
checks for orders:
  - row_count between 2 and 9
  - missing_count(code) = 0
  - invalid_count(year) = 0:
      valid min: 2011
      valid max: 2024
  - invalid_count(code) = 0:
      valid length: 2
  - failed rows:
      name: interval_logic
      fail condition:
        low IS NOT NULL
        AND low > high
"""


def test_yaml_checks_equal_those_written_in_python(df):
    loaded = yaml_checks.load_suites(YAML)
    assert loaded == {
        "orders": [
            ck.RowCountRule(None, 2, 9),
            ck.MissingCountZero("code"),
            ck.InvalidCountZero("year", 2011, 2024),
            ck.InvalidCountZero("code", length=2),
            ck.NoFailedRows("interval_logic", "low IS NOT NULL AND low > high"),
        ]
    }
    counts = [r.unexpected_count for r in suites.run_suite(df, loaded["orders"], "orders").collect()]
    assert counts == [0, 1, 2, 1, 1]


@pytest.mark.parametrize(
    "line",
    ["freshness(ts) < 1d", "missing_count(a) < 5", "invalid_count(a) = 0", "row_count between a and b"],
)
def test_unsupported_yaml_is_refused(line):
    with pytest.raises(ValueError):
        yaml_checks.load_suites(f"checks for t:\n  - {line}\n")


def test_yaml_refuses_unknown_rules_and_sections():
    with pytest.raises(ValueError):
        yaml_checks.load_suites("checks for t:\n  - invalid_count(a) = 0:\n      valid format: email\n")
    with pytest.raises(ValueError):
        yaml_checks.load_suites("profile for t:\n  - row_count between 1 and 2\n")
    assert yaml_checks.load_suites("") == {}


def test_missing_and_unreadable_values_have_one_policy(spark):
    rows = [(1.0, "1"), (float("nan"), "12x"), (None, None), (5.0, "5"), (20.0, "20")]
    df = spark.createDataFrame(rows, "v double, t string")
    checks = [ck.ValuesBetween("v", 0, 10), ck.ValuesBetween("t", 0, 10), ck.ValuesNotNull("v"), ck.ValuesNotNull("t")]
    counts = [r.unexpected_count for r in suites.run_suite(df, checks, "d").collect()]
    assert sorted(counts) == [1, 1, 2, 2]


def test_runs_of_a_dataset_have_verdicts_of_their_own(spark):
    from datetime import datetime

    good, bad = spark.range(3), spark.range(30)
    check = [ck.RowCountBetween(None, 1, 10)]
    results = suites.run_suite(good, check, "d", datetime(2024, 1, 1)).unionByName(
        suites.run_suite(bad, check, "d", datetime(2024, 1, 2))
    )
    assert sorted((r.run_ts.day, r.success, r.total) for r in suites.summarise(results).collect()) == [
        (1, True, 1), (2, False, 1),
    ]
    assert sorted((r.run_ts.day, r.overall_pass) for r in suites.with_overall_pass(results).collect()) == [
        (1, True), (2, False),
    ]


def test_reports_are_kept_by_run_and_only_the_newest_are_opened(spark, tmp_path):
    folder = str(tmp_path / "reports")
    for dataset in ("a", "b:c d"):
        for day in (1, 2, 3):
            checks = [ck.RowCountBetween(None, 0, 10), ck.ValuesNotNull("id")]
            suites.validate(spark, {dataset: (spark.range(day), checks)}, folder, datetime(2024, 1, day, 1, 2, 3, day))
    assert suites.read_reports(spark, folder).count() == 12
    newest = suites.read_newest_reports(spark, folder)
    assert sorted({(r.dataset, r.run_ts.day) for r in newest.collect()}) == [("a", 2), ("a", 3), ("b:c d", 2), ("b:c d", 3)]
    assert len(newest.inputFiles()) == 4 * len(suites.read_newest_reports(spark, folder, 1).inputFiles()) // 2
    assert all("/run=20240101" not in f for f in newest.inputFiles())
    # A run reads back its own reports, not the history.
    again = suites.validate(spark, {"a": (spark.range(5), [ck.RowCountBetween(None, 0, 10)])}, folder, datetime(2024, 2, 1))
    assert [r.observed for r in again.collect()] == [5.0] and all("run=20240201" in f for f in again.inputFiles())
    (tmp_path / "empty").mkdir()
    assert suites.read_newest_reports(spark, str(tmp_path / "empty")).collect() == []


def test_files_are_batches_and_a_failed_one_is_named(spark, tmp_path):
    for name, rows in (("good", "a\n1\n2\n"), ("bad", "a\n1\n\n")):
        (tmp_path / f"{name}.v1.csv").write_text(rows)
    files = sorted(str(p) for p in tmp_path.glob("*.csv"))
    results = suites.validate_files(
        spark, files, scan.read_csv, lambda _: [ck.RowCountBetween(None, 2, 2)], str(tmp_path / "reports")
    )
    summary = {r.dataset: (r.success, r.total, r.failed, r.failed_file) for r in suites.run_summary(results).collect()}
    assert summary == {"good": (True, 1, 0, None), "bad": (False, 1, 1, files[0])}
    with pytest.raises(FileNotFoundError):
        suites.validate_files(spark, [], scan.read_csv, lambda _: [], str(tmp_path / "reports"))


def test_known_values_are_counted_per_check(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, None)], "n int, t string")
    some, none = spark.createDataFrame([("a",)], "level string"), spark.createDataFrame([], "level string")
    checks = [
        ck.ValuesKnown("t", some), ck.ValuesUnique("n"), ck.ValuesKnown("t", none), ck.ValuesKnown("gone", some),
        ck.ValuesKnown("n", spark.range(1, 3).withColumnRenamed("id", "level")), ck.ValuesUnique("n"),
    ]
    got = [(r.column, r.success, r.unexpected_count) for r in suites.run_suite(df, checks, "d").collect()]
    assert sorted(got, key=repr) == sorted(
        [("t", False, 1), ("n", False, 2), ("t", False, 3), ("gone", False, None), ("n", True, 0), ("n", False, 2)], key=repr)
