"""Run history, drift between runs and baselines: a day of events of one type is a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from clearwell.operators import drift


@query("""
SELECT avg(CASE WHEN value < 5 THEN 1.0 ELSE 0.0 END) AS value_null_rate,
  avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS user_id_null_rate,
  CAST(0 AS DOUBLE) AS event_id_null_rate
FROM events
""")
def null_rate(spark, folder):
    events = table(spark, folder, "events").select(
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"),
        "event_id",
    )
    return drift.null_rates(events, "value", "user_id", "event_id")


def daily_runs(spark, folder):
    """One row per event type and day; a value below 5 counts as missing."""
    events = table(spark, folder, "events")
    missing = F.avg((F.col("value") < 5).cast("int"))
    return events.groupBy(
        F.col("event_type").alias("dataset"), F.date_format("ts", "yyyy-MM-dd").alias("run_ts")
    ).agg(F.count(F.lit(1)).alias("row_count"), missing.alias("null_rate"))


RUNS = """
WITH runs AS (
  SELECT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS run_ts, count(*) AS row_count,
    avg(CASE WHEN value < 5 THEN 1.0 ELSE 0.0 END) AS null_rate
  FROM events GROUP BY 1, 2
), paired AS (
  SELECT *, lag(row_count) OVER w AS prev_row_count, lag(null_rate) OVER w AS prev_null_rate
  FROM runs WINDOW w AS (PARTITION BY dataset ORDER BY run_ts)
)
"""


@query(f"""{RUNS}
SELECT dataset, run_ts, row_count, prev_row_count,
  round((prev_row_count - row_count) / CAST(prev_row_count AS DOUBLE), 6) AS drop_ratio,
  coalesce((prev_row_count - row_count) / CAST(prev_row_count AS DOUBLE) > 0.10, false) AS volume_alarm
FROM paired
""")
def drift_volume(spark, folder):
    compared = drift.compare_runs(daily_runs(spark, folder))
    return compared.select(
        "dataset",
        "run_ts",
        "row_count",
        "prev_row_count",
        F.round("drop_ratio", 6).alias("drop_ratio"),
        "volume_alarm",
    )


@query(f"""{RUNS}
SELECT dataset, run_ts, round(null_rate, 6) AS null_rate, round(prev_null_rate, 6) AS prev_null_rate,
  round(null_rate - prev_null_rate, 6) AS null_rate_rise,
  coalesce(null_rate - prev_null_rate > 0.05, false) AS null_rate_alarm
FROM paired
""")
def drift_null_rate(spark, folder):
    compared = drift.compare_runs(daily_runs(spark, folder))
    rounded = {c: F.round(c, 6) for c in ("null_rate", "prev_null_rate", "null_rate_rise")}
    return compared.withColumns(rounded).select(
        "dataset", "run_ts", "null_rate", "prev_null_rate", "null_rate_rise", "null_rate_alarm"
    )


@query(f"""{RUNS}
SELECT dataset, run_ts, row_count,
  coalesce((prev_row_count - row_count) / CAST(prev_row_count AS DOUBLE) > 0.10, false) AS volume_alarm,
  coalesce(null_rate - prev_null_rate > 0.05, false) AS null_rate_alarm
FROM paired QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY run_ts DESC) = 1
""")
def drift_newest_run(spark, folder):
    compared = drift.compare_runs(daily_runs(spark, folder), newest_only=True)
    return compared.select("dataset", "run_ts", "row_count", "volume_alarm", "null_rate_alarm")


@query("""
WITH halves AS (
  SELECT event_type AS dataset, count(*) FILTER (WHERE day(ts) <= 15) AS baseline,
    count(*) FILTER (WHERE day(ts) > 15) AS row_count
  FROM events GROUP BY 1
)
SELECT dataset, baseline, row_count,
  round(abs(row_count - baseline) / CAST(baseline AS DOUBLE), 6) AS deviation,
  abs(row_count - baseline) / CAST(baseline AS DOUBLE) < 0.10 AS stable
FROM halves
""")
def baseline_tolerance(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "dataset")
    first_half = F.dayofmonth("ts") <= 15
    baselines = events.filter(first_half).groupBy("dataset").agg(F.count(F.lit(1)).alias("baseline"))
    counts = events.filter(~first_half).groupBy("dataset").agg(F.count(F.lit(1)).alias("row_count"))
    compared = drift.within_baseline(counts, baselines)
    return compared.withColumn("deviation", F.round("deviation", 6))
