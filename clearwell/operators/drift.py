"""Comparing a run with the one before it, and row counts with a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clearwell.functions.numbers import drop_ratio, point_change
from clearwell.operators.checks import RowCountBetween, RowCountRule, ValuesNotNull
from clearwell.operators.columns import is_missing

# The changes that are still accepted.
VOLUME_DROP = 0.10
NULL_RATE_RISE = 0.05
BASELINE_TOLERANCE = 0.10


def null_rates(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the share of NULL and NaN in each column, named ``<column>_null_rate``."""
    return df.agg(*[F.avg(is_missing(df, c).cast("int")).alias(f"{c}_null_rate") for c in columns])


def run_history(results: DataFrame, metric: str = "data_value") -> DataFrame:
    """Row count and null rate of the metric for every run in a results table."""
    counted = F.col("expectation").isin(RowCountBetween.kind, RowCountRule.kind)
    nulls = (F.col("expectation") == ValuesNotNull.kind) & (F.col("column") == metric)
    return results.groupBy("dataset", "run_ts").agg(
        F.max(F.when(counted, F.col("observed"))).cast("bigint").alias("row_count"),
        F.max(F.when(nulls, F.col("unexpected_pct") / 100)).alias("null_rate"),
    )


def compare_runs(history: DataFrame, newest_only: bool = False) -> DataFrame:
    """Pair every run with the previous one of its dataset and flag alarms.

    A window group holds the runs of one dataset: one row per run, however large the runs were.
    A fall to 0 rows is a drop of 100 % and alarms; growth and a first run do not.
    """
    in_order = Window.partitionBy("dataset").orderBy("run_ts")
    paired = history.withColumns(
        {
            "prev_row_count": F.lag("row_count").over(in_order),
            "prev_null_rate": F.lag("null_rate").over(in_order),
        }
    )
    if newest_only:
        newest = Window.partitionBy("dataset").orderBy(F.col("run_ts").desc())
        paired = (
            paired.withColumn("__age", F.row_number().over(newest)).filter("__age = 1").drop("__age")
        )
    drop = drop_ratio(F.col("prev_row_count"), F.col("row_count"))
    rise = point_change(F.col("prev_null_rate"), F.col("null_rate"))
    return paired.withColumns(
        {
            "drop_ratio": drop,
            "null_rate_rise": rise,
            "volume_alarm": F.coalesce(drop > VOLUME_DROP, F.lit(False)),
            "null_rate_alarm": F.coalesce(rise > NULL_RATE_RISE, F.lit(False)),
        }
    )


class DriftDetected(ValueError):
    """A run differs too much from the one before it."""


def enforce_no_drift(compared: DataFrame) -> None:
    """Raise with all alarms in one message; there is at most one row per run."""
    alarms = compared.filter("volume_alarm OR null_rate_alarm").orderBy("dataset", "run_ts").collect()
    lines = []
    for a in alarms:
        if a.volume_alarm:
            lines.append(
                f"volume [{a.dataset}]: {a.drop_ratio:.1%} drop ({a.prev_row_count} to {a.row_count})"
            )
        if a.null_rate_alarm:
            lines.append(
                f"null rate [{a.dataset}]: {a.prev_null_rate:.1%} to {a.null_rate:.1%}"
            )
    if lines:
        raise DriftDetected("drift detected:\n" + "\n".join(lines))


def within_baseline(
    counts: DataFrame, baselines: DataFrame, tolerance: float = BASELINE_TOLERANCE
) -> DataFrame:
    """Compare ``dataset, row_count`` with ``dataset, baseline``; the deviation must stay below
    the tolerance in both directions. A dataset without rows of its own counts as 0 rows."""
    joined = baselines.join(counts, "dataset", "left")
    rows = F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint")
    deviation = F.try_divide(F.abs(rows - F.col("baseline")), F.col("baseline"))
    return joined.select(
        "dataset",
        "baseline",
        rows.alias("row_count"),
        deviation.alias("deviation"),
        F.coalesce(deviation < tolerance, F.lit(False)).alias("stable"),
    )
