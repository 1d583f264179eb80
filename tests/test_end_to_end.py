"""Whole runs: landing to published tables with reports and drift."""

from __future__ import annotations

from datetime import datetime

import pytest

from clearwell.operators import checks as ck, drift, suites, yaml_checks
from clearwell.plans import datasets as ds
from clearwell.plans.curate import curate
from clearwell.plans.layers import Layers, run_datasets
from clearwell.plans.standardise import standardise
from clearwell.sources import scan, sinks, tables

HEADER = (
    "Year,LocationAbbr,LocationDesc,GeographicLevel,DataSource,Class,Topic,Data_Value,Data_Value_Unit,"
    "Data_Value_Type,Data_Value_Footnote_Symbol,Data_Value_Footnote,StratificationCategory1,"
    "Stratification1,StratificationCategory2,Stratification2,TopicID,LocationID,Y_lat,X_lon,Georeference\n"
)


def heart_csv(path, rows: int) -> str:
    """A landing file with one copy, one territory, one row without a metric and ``rows`` others."""
    line = '2020,{code},"Some, place {n}",State,NVSS,Heart,Mortality,{value},"per 100,000 population",Rate,' \
           "{mark},,Sex,Male,Race,All,T2,{n},1.5,-2.5,POINT (-2.5 1.5)\n"
    made = [line.format(code=("AL", "AK")[n % 2], n=n, value=100 + n, mark="") for n in range(rows)]
    made += [made[0], line.format(code="PR", n=900, value=1, mark="~"), line.format(code="AL", n=901, value="", mark="")]
    path.write_text(HEADER + "".join(made))
    return str(path)


def test_curated_run(spark, tmp_path):
    reports = str(tmp_path / "reports")
    layers = Layers(spark, str(tmp_path / "layers"))
    for hour, rows in ((1, 40), (2, 30)):
        raw = scan.read_csv(spark, heart_csv(tmp_path / f"heart{hour}.csv", rows), ds.HEART.raw)
        gold = layers.run({"heart": raw}, lambda bronze: curate(bronze, ties=["location_id"]))["heart"]
        assert gold.count() == rows
        assert gold.filter("location_abbr = 'AL'").orderBy("row_num").first().data_value == 100 + rows - 2
        checks = [ck.RowCountBetween(None, 1, 100), ck.ValuesNotNull("data_value"), ck.ValuesUnique("location_id")]
        results = suites.validate(spark, {"heart": (gold, checks)}, reports, datetime(2024, 1, 1, hour))
        suites.enforce(results)
        target = tables.truncate_and_load(gold, "heart_run_test", str(tmp_path / "target"), ds.WAREHOUSE_HEART)
        assert target.count() == rows and target.schema["topic_id"].dataType.simpleString() in ("string", "varchar(50)")
    compared = drift.compare_runs(drift.run_history(suites.read_reports(spark, reports)), newest_only=True)
    with pytest.raises(drift.DriftDetected, match=r"25.0% drop \(40 to 30\)"):
        drift.enforce_no_drift(compared)


def test_standardised_run(spark, tmp_path):
    landing = heart_csv(tmp_path / "heart.csv", 20)
    cleaned = str(tmp_path / "cleaned")
    run_datasets(spark, {landing: cleaned}, standardise, sinks.write_csv,
                 lambda spark, path: scan.read_csv(spark, path, ds.HEART.raw))
    batch = scan.read_csv(spark, cleaned, infer=True)
    assert batch.count() == 22 and len(batch.columns) == 16
    assert batch.filter("data_value = 0").count() == 1

    rules = yaml_checks.load_suites(
        "checks for heart:\n  - row_count between 1 and 99\n  - missing_count(year) = 0\n"
        "  - invalid_count(location_abbr) = 0:\n      valid length: 2\n"
    )
    suites.enforce(suites.run_suite(batch, rules["heart"], "heart"))
    failing = ds.HEART.expectations(batch)
    with pytest.raises(suites.ChecksFailed, match="row_count"):
        suites.enforce(suites.run_suite(batch, failing, "heart"))

    loaded = {}
    sinks.load_files(spark, {cleaned: "heart", str(tmp_path / "absent"): "none"},
                     lambda df, table: loaded.update({table: df.count()}))
    assert loaded == {"heart": 22}
