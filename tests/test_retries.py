"""Results when tasks fail and run again, with their rows in another order each time."""

from __future__ import annotations

import os
import random
import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from clearwell.operators import checks as ck, keyvalue, ranking, rows as ops, suites
from clearwell.plans.curate import curate
from clearwell.sources import sinks


def unreliable(df, folder):
    """The same rows, from tasks that fail at the first attempt and shuffle their rows at each."""

    def passed_on(batches):
        context = TaskContext.get()
        marker = f"{folder}/{context.stageId()}-{context.partitionId()}"
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("lost")
        for pdf in batches:
            yield pdf.sample(frac=1, random_state=random.randrange(2**31))

    return df.mapInPandas(passed_on, df.schema)


@pytest.fixture
def reports(spark):
    """2000 reports, half of them of one location, with many equal metrics."""
    return spark.range(0, 2000, 1, 6).selectExpr(
        "if(id % 2 = 0, 'AL', element_at(array('AK', 'AZ', 'US'), cast(1 + id % 3 AS int))) AS LocationAbbr",
        "cast(id % 17 AS double) AS DataValue",
        "id AS RecordID",
        "cast(null AS string) AS Response",
    )


def test_the_ranking_is_right_although_every_task_fails_once(spark, reports, tmp_path):
    ranked = ranking.rank_by_value(unreliable(reports, str(tmp_path)), "LocationAbbr", "DataValue", ["RecordID"])
    plain = ranking.rank_by_value(reports, "LocationAbbr", "DataValue", ["RecordID"], distinct=True)
    assert os.listdir(tmp_path)
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, plain.collect()))
    # The staged places do not change between two evaluations.
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, plain.collect()))


def test_the_default_ties_do_not_depend_on_the_order_of_rows(spark, reports, tmp_path):
    ranked = ranking.rank_by_value(unreliable(reports, str(tmp_path)), "LocationAbbr", "DataValue")
    plain = ranking.rank_by_value(reports, "LocationAbbr", "DataValue", distinct=True)
    assert sorted(map(repr, ranked.collect())) == sorted(map(repr, plain.collect()))


def test_curation_dedupe_and_checks(spark, reports, tmp_path):
    folders = [tmp_path / str(i) for i in range(3)]
    for f in folders:
        f.mkdir()
    doubled = reports.union(reports)
    curated = curate(unreliable(doubled, str(folders[0])), ties=["record_id"])
    assert sorted(map(tuple, curated.collect())) == sorted(map(tuple, curate(reports, ties=["record_id"]).collect()))
    assert ops.dedupe(unreliable(doubled, str(folders[1]))).count() == 2000
    counted = suites.run_suite(unreliable(doubled, str(folders[2])), [ck.ValuesUnique("RecordID")], "d").first()
    assert counted.unexpected_count == 4000


def test_written_items_are_whole_and_counted_once(spark, reports, tmp_path):
    store, marks = tmp_path / "store", tmp_path / "marks"
    store.mkdir()
    marks.mkdir()

    def put_batch(items):
        for item in items:
            with open(f"{store}/{item['RecordID']}", "w") as out:
                out.write("x")
        marker = f"{marks}/{TaskContext.get().partitionId()}"
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("lost after the first batch")

    items = keyvalue.items(reports, ["RecordID"])
    assert sinks.write_items(items, put_batch) == 2000
    assert len(os.listdir(store)) == 2000 and len(os.listdir(marks)) == 6


def test_written_rows_are_counted_once(spark, reports, tmp_path):
    report = sinks.write_and_verify(unreliable(reports, str(tmp_path)), str(tmp_path / uuid.uuid4().hex)).first()
    assert (report.rows_written, report.rows_read, report.complete) == (2000, 2000, True)


def test_batches_stay_consecutive(spark, reports, tmp_path):
    numbered = keyvalue.batch_numbers(unreliable(reports, str(tmp_path)), ["RecordID"])
    assert numbered.filter(F.col("batch_no") != F.floor(F.col("RecordID") / 25)).count() == 0
