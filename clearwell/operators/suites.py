"""Running check suites, summing up their results and reading older reports."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from clearwell.functions.runs import RUN_LAYOUT
from clearwell.functions.text import equality_key
from clearwell.operators.checks import Check, ValuesKnown, ValuesUnique
from clearwell.operators.columns import col, on_text_columns

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("observed", T.DoubleType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("unexpected_pct", T.DoubleType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# The default layout keeps milliseconds only, so a run would not find its own reports.
_REPORT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def run_suite(
    df: DataFrame,
    checks: Sequence[Check],
    dataset: str,
    run_ts: datetime | Column | None = None,
    skip_absent: bool = False,
    source_file: str | None = None,
) -> DataFrame:
    """One result row per check, from one pass over the columns the checks need.

    All checks share one aggregate; uniqueness adds one grouped aggregate for all unique columns, known categories
    another. A check on an absent column fails, or is left out with ``skip_absent``. ``source_file`` is kept
    with the results of a batch that came as one file.
    """
    if skip_absent:
        checks = [c for c in checks if c.applies_to(df)]
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    moment = run_ts if isinstance(run_ts, Column) else F.lit(run_ts or datetime.now())

    measures = []
    for i, check in enumerate(checks):
        known = check.applies_to(df)
        broken = check.broken(df) if known else None
        count = F.count_if(broken) if broken is not None else F.lit(0).cast("bigint")
        measures += [
            count.alias(f"bad_{i}"),
            (check.considered(df) if known else F.count(F.lit(1))).alias(f"of_{i}"),
            (check.observed(df) if known else F.lit(None).cast("double")).alias(f"seen_{i}"),
        ]
    measured = df.agg(*measures)

    lines = F.array(*[_line(df, check, i) for i, check in enumerate(checks)])
    results = measured.select(F.explode(lines).alias("line")).select("line.*")
    counted = _counts_apart(df, checks)
    if counted is not None:
        results = _with_counts(results, counted)
    percent = F.coalesce(F.try_divide(F.lit(100.0) * col("unexpected_count"), col("considered")), F.lit(0.0))
    return results.select(
        F.lit(dataset).alias("dataset"),
        moment.cast("timestamp").alias("run_ts"),
        "expectation",
        "column",
        "success",
        "observed",
        "unexpected_count",
        percent.alias("unexpected_pct"),
        F.lit(source_file).cast("string").alias("source_file"),
    )


def _line(df: DataFrame, check: Check, i: int) -> Column:
    known = check.applies_to(df)
    bad = col(f"bad_{i}") if known else F.lit(None).cast("bigint")
    seen = col(f"seen_{i}")
    verdict = check.passes(seen, bad) if known else F.lit(False)
    return F.struct(
        F.lit(i).alias("position"),
        F.lit(check.kind).alias("expectation"),
        F.lit(check.column).cast("string").alias("column"),
        F.coalesce(verdict, F.lit(False)).alias("success"),
        seen.alias("observed"),
        bad.alias("unexpected_count"),
        col(f"of_{i}").alias("considered"),
    )


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, the number of non-null rows whose value occurs more than once.

    One scan and one shuffle serve all columns, as grouping sets of one column each. Equal values
    are counted inside each task first, so a value held by a third of all rows is no hot key, and
    long texts travel as digests.
    """
    keys = on_text_columns(df.select(*[col(c) for c in columns]), equality_key)
    names = [col(c) for c in columns]
    occurrences = keys.groupingSets([[n] for n in names], *names).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__times")
    )
    # The bit of a column, the first being the highest, is 0 in its own set and 1 in the others.
    every = 2 ** len(columns) - 1
    sets = [every - 2 ** (len(columns) - 1 - i) for i in range(len(columns))]
    repeated = [
        F.sum(F.when((col("__set") == s) & n.isNotNull() & (col("__times") > 1), col("__times")))
        for s, n in zip(sets, names)
    ]
    counted = occurrences.agg(*[r.alias(f"r{i}") for i, r in enumerate(repeated)])
    lines = [
        F.struct(F.lit(c).alias("column"), F.coalesce(col(f"r{i}"), F.lit(0)).alias("repeated"))
        for i, c in enumerate(columns)
    ]
    return counted.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def unknown_values(df: DataFrame, checks: Mapping[int, ValuesKnown]) -> DataFrame:
    """``position, n``: for every check the number of non-null rows whose value its table does not have.

    Equal values are counted inside each task first, so what is shuffled and joined are distinct values; Spark
    broadcasts the tables of categories if they measure little.
    """
    cells = [F.struct(F.lit(i).alias("position"), col(c.column).cast("string").alias("level")) for i, c in checks.items()]
    seen = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("level IS NOT NULL")
    seen = seen.groupBy("position", "level").agg(F.count(F.lit(1)).alias("n"))
    known = [
        c.levels.select(F.lit(i).alias("position"), F.col("level").cast("string").alias("level")) for i, c in checks.items()
    ]
    unknown = seen.join(reduce(DataFrame.unionByName, known), ["position", "level"], "left_anti")
    return unknown.groupBy("position").agg(F.sum("n").alias("n"))


def _counts_apart(df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """``position, n`` of the checks whose unexpected rows need a shuffle; at most one row per check."""
    here = [(i, c) for i, c in enumerate(checks) if c.applies_to(df)]
    unique = {i: c.column for i, c in here if isinstance(c, ValuesUnique)}
    known = {i: c for i, c in here if isinstance(c, ValuesKnown)}
    counted = []
    if unique:
        names = sorted(set(unique.values()))
        places = F.create_map(*[x for name in names for x in (
            F.lit(name), F.array(*[F.lit(i) for i, c in unique.items() if c == name]))])
        repeated = repeated_values(df, names)
        counted.append(repeated.select(F.explode(places[F.col("column")]).alias("position"), F.col("repeated").alias("n")))
    if known:
        positions = [F.struct(F.lit(i).alias("position"), F.lit(0).cast("bigint").alias("n")) for i in known]
        none = df.sparkSession.range(1).select(F.explode(F.array(*positions)).alias("x")).select("x.*")
        found = unknown_values(df, known).unionByName(none)
        counted.append(found.groupBy("position").agg(F.sum("n").alias("n")))
    return reduce(DataFrame.unionByName, counted) if counted else None


def _with_counts(results: DataFrame, counted: DataFrame) -> DataFrame:
    # The hinted side has one row per check of the suite.
    joined = results.join(F.broadcast(counted.withColumnRenamed("n", "__n")), "position", "left")
    return joined.withColumns(
        {
            "success": F.when(F.col("__n").isNotNull(), F.col("__n") == 0).otherwise(F.col("success")),
            "unexpected_count": F.coalesce("__n", "unexpected_count"),
        }
    )


def run_suites(
    batches: Mapping[str, tuple[DataFrame, Sequence[Check]]],
    run_ts: datetime | Column | None = None,
    skip_absent: bool = False,
) -> DataFrame:
    """Results of all datasets in one table."""
    moment = run_ts if run_ts is not None else datetime.now()
    parts = [run_suite(df, checks, name, moment, skip_absent) for name, (df, checks) in batches.items()]
    return reduce(DataFrame.unionByName, parts)


def summarise(results: DataFrame) -> DataFrame:
    """Per dataset and run: how many checks ran, passed and failed, and the overall verdict."""
    return results.groupBy("dataset", "run_ts").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Per batch and run the counts of :func:`summarise`, and the file of the batch if a check failed."""
    return results.groupBy("dataset", "run_ts").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
        F.max(F.when(~F.col("success"), F.col("source_file"))).alias("failed_file"),
    )


def with_overall_pass(results: DataFrame) -> DataFrame:
    """Add the verdict of its dataset and run to every check; the groups are as large as a suite."""
    whole = Window.partitionBy("dataset", "run_ts")
    return results.withColumn("overall_pass", F.bool_and("success").over(whole))


class ChecksFailed(ValueError):
    """At least one check did not pass."""


def enforce(results: DataFrame) -> DataFrame:
    """Raise with all failed checks in one message; ``results`` has one row per check."""
    failed = results.filter(~F.col("success")).select("dataset", "expectation", "column").collect()
    if failed:
        lines = [f"{r.dataset}: {r.expectation}({r.column or ''})" for r in failed]
        raise ChecksFailed("checks failed:\n" + "\n".join(sorted(lines)))
    return results


#: Names a run's folder in the report store; sorts by time.
_RUN_FOLDER = "yyyyMMdd_HHmmss_SSSSSS"


def run_folder(run_ts: Column) -> Column:
    return F.date_format(run_ts, _RUN_FOLDER)


def write_reports(results: DataFrame, folder: str) -> None:
    """Append to the run history, one folder per dataset and run."""
    placed = results.withColumn("run", run_folder(F.col("run_ts")))
    placed.write.mode("append").partitionBy("dataset", "run").option("timestampFormat", _REPORT_TIME).json(folder)


def read_reports(spark: SparkSession, folder: str, paths: Sequence[str] = ()) -> DataFrame:
    """The run history, or only the runs in ``paths``, folders below ``folder``."""
    schema = T.StructType([*RESULT_SCHEMA, T.StructField("run", T.StringType())])
    reader = spark.read.schema(schema).option("timestampFormat", _REPORT_TIME).option("basePath", folder)
    return reader.json(list(paths) or folder).select(*RESULT_SCHEMA.names)


def newest_runs(spark: SparkSession, folder: str, runs: int = 2) -> list[str]:
    """Folders of the newest ``runs`` of every dataset: found by listing files, no report is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    place = r"^(.*/dataset=([^/]+)/run=([^/]+))/[^/]+$"
    at, dataset, run = (F.regexp_extract("path", place, i) for i in (1, 2, 3))
    found = files.load(folder).select(at.alias("at"), dataset.alias("dataset"), run.alias("run")).filter("run <> ''")
    newest_first = Window.partitionBy("dataset").orderBy(F.col("run").desc())
    ranked = found.distinct().withColumn("age", F.row_number().over(newest_first))
    return [r.at for r in ranked.filter(F.col("age") <= runs).select("at").collect()]


def read_newest_reports(spark: SparkSession, folder: str, runs: int = 2) -> DataFrame:
    """Reports of the newest ``runs`` of every dataset; older files are not opened."""
    paths = newest_runs(spark, folder, runs)
    return read_reports(spark, folder, paths) if paths else spark.createDataFrame([], RESULT_SCHEMA)


def as_documents(results: DataFrame) -> DataFrame:
    """One nested JSON document per dataset and run; a document is as long as its suite."""
    entry = F.struct(
        F.col("success"),
        F.struct(
            F.col("expectation").alias("type"), F.struct(F.col("column")).alias("kwargs")
        ).alias("expectation_config"),
        F.struct(
            F.col("observed").alias("observed_value"),
            F.col("unexpected_count"),
            F.col("unexpected_pct").alias("unexpected_percent"),
        ).alias("result"),
    )
    grouped = results.groupBy("dataset", "run_ts").agg(
        F.bool_and("success").alias("success"), F.collect_list(entry).alias("results")
    )
    return grouped.select("dataset", "run_ts", F.to_json(F.struct("success", "results")).alias("document"))


def validate(
    spark: SparkSession,
    batches: Mapping[str, tuple[DataFrame, Sequence[Check]]],
    folder: str,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Run all suites, keep their reports, and return those of this run from the kept files.

    The tables are read once, however often the returned results are used.
    """
    moment = run_ts or datetime.now()
    write_reports(run_suites(batches, moment), folder)
    return _reports_of(spark, folder, moment)


def _reports_of(spark: SparkSession, folder: str, moment: datetime) -> DataFrame:
    """The reports of one run; only its own folders are opened."""
    label = spark.range(1).select(run_folder(F.lit(moment).cast("timestamp"))).first()[0]
    return read_reports(spark, folder, [f"{folder}/dataset=*/run={label}"])


def validate_files(
    spark: SparkSession,
    files: Iterable[str],
    read: Callable[[SparkSession, str], DataFrame],
    suite: Callable[[DataFrame], Sequence[Check]],
    folder: str,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Validate every file as a batch named after it and keep the reports, with the file each came from.

    No file at all is an error. The driver goes over a handful of batches; each is one distributed aggregate.
    """
    moment = run_ts or datetime.now()
    parts = []
    for file in files:
        batch = read(spark, file)
        name = re.sub(r"\..*$", "", file.rstrip("/").rsplit("/", 1)[-1])
        parts.append(run_suite(batch, suite(batch), name, moment, source_file=file))
    if not parts:
        raise FileNotFoundError("no files to validate")
    write_reports(reduce(DataFrame.unionByName, parts), folder)
    return _reports_of(spark, folder, moment)


def read_nested_reports(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Read validation reports kept as one nested JSON document per run.

    The dataset and the run come from the file name, as in ``gx_<dataset>_20240131_235959.json``.
    """
    setting = T.StructType([T.StructField("column", T.StringType())])
    config = T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("kwargs", setting)]
    )
    outcome = T.StructType(
        [
            T.StructField("observed_value", T.StringType()),
            T.StructField("unexpected_count", T.LongType()),
            T.StructField("unexpected_percent", T.DoubleType()),
        ]
    )
    entry = T.StructType(
        [
            T.StructField("success", T.BooleanType()),
            T.StructField("expectation_config", config),
            T.StructField("result", outcome),
        ]
    )
    document = T.StructType([T.StructField("results", T.ArrayType(entry))])
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^gx_(.*)_\d{8}_\d{6}\.json$", 1)
    moment = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{8}_\d{6})\.json$", 1)
    reports = spark.read.schema(document).option("multiLine", True).json(paths)
    return reports.select(
        name.alias("dataset"),
        F.try_to_timestamp(moment, F.lit(RUN_LAYOUT)).alias("run_ts"),
        F.explode("results").alias("entry"),
    ).select(
        "dataset",
        "run_ts",
        F.col("entry.expectation_config.type").alias("expectation"),
        F.col("entry.expectation_config.kwargs.column").alias("column"),
        F.col("entry.success").alias("success"),
        F.col("entry.result.observed_value").try_cast("double").alias("observed"),
        F.col("entry.result.unexpected_count").alias("unexpected_count"),
        F.coalesce("entry.result.unexpected_percent", F.lit(0.0)).alias("unexpected_pct"),
        F.lit(None).cast("string").alias("source_file"),
    )
