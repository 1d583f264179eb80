"""Data-quality checks and suites."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from catalogue.columns import intervals
from catalogue.registry import query, table
from clearwell.operators import checks as ck, drift, suites, yaml_checks
from clearwell.operators.columns import with_interval_flag
from clearwell.plans.datasets import Dataset
from clearwell.session import new_folder
from clearwell.sources import scan, sinks


def line(dataset: str, kind: str, column: str | None, source: str, passed: str, observed: str = "NULL",
         bad: str = "0", of: str = "count(*)") -> str:
    """SQL for one result row; ``bad`` is the number of unexpected rows, ``of`` what it relates to."""
    name = "NULL" if column is None else f"'{column}'"
    return f"""
SELECT '{dataset}' AS dataset, '{kind}' AS expectation, CAST({name} AS VARCHAR) AS "column",
  {passed} AS success, CAST({observed} AS DOUBLE) AS observed,
  CAST({bad} AS BIGINT) AS unexpected_count,
  round(coalesce(100.0 * CAST({bad} AS DOUBLE) / nullif(CAST({of} AS DOUBLE), 0), 0.0), 6) AS unexpected_pct
FROM {source}"""


def value_line(dataset, kind, column, source, bad_where, of="count(*)"):
    bad = f"count(*) FILTER (WHERE {bad_where})"
    return line(dataset, kind, column, source, f"{bad} = 0", bad=bad, of=of)


def rows_line(dataset, source, low, high, kind="expect_table_row_count_to_be_between"):
    return line(dataset, kind, None, source, f"count(*) BETWEEN {low} AND {high}", "count(*)")


def fixed_line(dataset, kind, column, source, observed, passed):
    return line(dataset, kind, column, source, passed, observed)


def unique_line(dataset, column, source):
    repeats = f"(SELECT count(*) AS n, {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"
    bad = "coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0)"
    return line(dataset, "expect_column_values_to_be_unique", column, repeats, f"{bad} = 0", bad=bad,
                of="sum(n)")


def union(*lines: str) -> str:
    return "\nUNION ALL\n".join(lines)


def comparable(results: DataFrame) -> DataFrame:
    return results.drop("run_ts", "source_file").withColumn("unexpected_pct", F.round("unexpected_pct", 6))


def single(df: DataFrame, dataset: str, *checks: ck.Check) -> DataFrame:
    return comparable(suites.run_suite(df, checks, dataset))


def reported_orders(spark, folder):
    """Orders under report names, with a metric and a location that are unknown for some."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.col("o_custkey").alias("customer_id"),
        F.year("o_orderdate").alias("year"),
        F.when(priority != "5-LOW", F.col("o_totalprice")).alias("data_value"),
        F.when(status != "P", F.concat(status, status)).alias("location_abbr"),
    )


REPORTED = """(SELECT o_orderkey AS record_id, o_custkey AS customer_id, year(o_orderdate) AS year,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS data_value,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || o_orderstatus END AS location_abbr FROM orders)"""


@query(union(
    rows_line("orders", "orders", 1000, 200000),
    rows_line("orders", "orders", 1, 10),
))
def row_count_check(spark, folder):
    orders = table(spark, folder, "orders")
    return single(orders, "orders", ck.RowCountBetween(None, 1000, 200000), ck.RowCountBetween(None, 1, 10))


@query(union(
    fixed_line("orders", "expect_table_column_count_to_equal", None, "(SELECT count(*) FROM orders)", 6, "true"),
    fixed_line("orders", "expect_table_column_count_to_equal", None, "(SELECT count(*) FROM orders)", 6, "false"),
    fixed_line("orders", "expect_column_to_exist", "o_orderkey", "(SELECT count(*) FROM orders)", 1, "true"),
    fixed_line("orders", "expect_column_to_exist", "year_start", "(SELECT count(*) FROM orders)", 0, "false"),
    rows_line("orders", "orders", 1, 2000000000),
))
def schema_checks(spark, folder):
    orders = table(spark, folder, "orders")
    return single(
        orders,
        "orders",
        ck.ColumnCount(None, 6),
        ck.ColumnCount(None, 7),
        ck.ColumnExists("o_orderkey"),
        ck.ColumnExists("year_start"),
        ck.RowCountBetween(None, 1, 2000000000),
    )


@query(union(
    value_line("orders", "expect_column_values_to_be_between", "year", REPORTED,
               "year < 1996 OR year > 2000", "count(year)"),
    value_line("orders", "expect_column_values_to_be_between", "data_value", REPORTED,
               "data_value < 0 OR data_value > 499000", "count(data_value)"),
))
def check_between(spark, folder):
    return single(
        reported_orders(spark, folder),
        "orders",
        ck.ValuesBetween("year", 1996, 2000),
        ck.ValuesBetween("data_value", 0, 499000),
    )


@query(value_line("orders", "expect_column_values_to_be_in_set", "location_abbr", REPORTED,
                  "location_abbr NOT IN ('FF', 'US')", "count(location_abbr)"))
def check_in_set(spark, folder):
    return single(reported_orders(spark, folder), "orders", ck.ValuesInSet("location_abbr", ("FF", "US")))


@query(union(
    value_line("customer", "expect_column_values_to_match_regex", "c_name", "customer",
               "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')", "count(c_name)"),
    value_line("customer", "expect_column_values_to_match_regex", "c_mktsegment", "customer",
               "NOT regexp_matches(c_mktsegment, '^[A-M]+$')", "count(c_mktsegment)"),
))
def check_regex(spark, folder):
    return single(
        table(spark, folder, "customer"),
        "customer",
        ck.ValuesMatch("c_name", "^Customer#[0-9]{9}$"),
        ck.ValuesMatch("c_mktsegment", "^[A-M]+$"),
    )


@query(union(
    value_line("orders", "expect_column_values_to_not_be_null", "data_value", REPORTED, "data_value IS NULL"),
    value_line("orders", "missing_count", "year", REPORTED, "year IS NULL"),
    value_line("orders", "missing_count", "location_abbr", REPORTED, "location_abbr IS NULL"),
))
def check_not_null(spark, folder):
    return single(
        reported_orders(spark, folder),
        "orders",
        ck.ValuesNotNull("data_value"),
        ck.MissingCountZero("year"),
        ck.MissingCountZero("location_abbr"),
    )


@query(union(
    unique_line("orders", "record_id", REPORTED),
    unique_line("orders", "customer_id", REPORTED),
    unique_line("orders", "location_abbr", REPORTED),
))
def check_unique(spark, folder):
    names = ["record_id", "customer_id", "location_abbr"]
    return single(reported_orders(spark, folder), "orders", *[ck.ValuesUnique(c) for c in names])


@query(union(
    value_line("customer", "invalid_count", "c_acctbal", "customer", "c_acctbal < 0", "count(c_acctbal)"),
    value_line("customer", "invalid_count", "c_nationkey", "customer", "c_nationkey < 0", "count(c_nationkey)"),
))
def check_min_only(spark, folder):
    return single(
        table(spark, folder, "customer"),
        "customer",
        ck.InvalidCountZero("c_acctbal", 0),
        ck.InvalidCountZero("c_nationkey", 0),
    )


@query(union(
    value_line("orders", "invalid_count", "location_abbr", REPORTED, "length(location_abbr) <> 2",
               "count(location_abbr)"),
    value_line("customer", "invalid_count", "c_mktsegment", "customer", "length(c_mktsegment) <> 9",
               "count(c_mktsegment)"),
))
def check_length(spark, folder):
    return single(
        reported_orders(spark, folder), "orders", ck.InvalidCountZero("location_abbr", length=2)
    ).unionByName(
        single(table(spark, folder, "customer"), "customer", ck.InvalidCountZero("c_mktsegment", length=9))
    )


@query("""
WITH bounds AS (
  SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE year(o_orderdate) < 1996
), current AS (SELECT o_totalprice AS v FROM orders WHERE year(o_orderdate) >= 1996)
SELECT 'orders' AS dataset, 'expect_column_values_to_be_between' AS expectation,
  'o_totalprice' AS "column", count(*) FILTER (WHERE v < lo OR v > hi) = 0 AS success,
  CAST(NULL AS DOUBLE) AS observed, count(*) FILTER (WHERE v < lo OR v > hi) AS unexpected_count,
  round(100.0 * count(*) FILTER (WHERE v < lo OR v > hi) / count(v), 6) AS unexpected_pct
FROM current, bounds
""")
def learned_range(spark, folder):
    orders = table(spark, folder, "orders")
    early = F.year("o_orderdate") < 1996
    learned = ck.learn_ranges(orders.filter(early), ["o_totalprice"])
    return single(orders.filter(~early), "orders", *learned)


OUTSIDE = "high IS NOT NULL AND low IS NOT NULL AND price IS NOT NULL AND (high < price OR low > price)"
INTERVALS = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price,
  l_extendedprice * (1 - l_discount) AS low,
  CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * (1 + l_tax) - l_quantity END AS high FROM lineitem)"""


@query(value_line("lineitem", "failed_rows", "confidence_interval_logic", INTERVALS, OUTSIDE))
def check_failed_rows(spark, folder):
    check = ck.NoFailedRows("confidence_interval_logic", OUTSIDE)
    return single(intervals(spark, folder), "lineitem", check)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price FROM {INTERVALS} WHERE {OUTSIDE}")
def failed_rows_sample(spark, folder):
    return ck.failed_rows(intervals(spark, folder), OUTSIDE).drop("low", "high")


def all_suites(spark, folder):
    orders = reported_orders(spark, folder)
    customer = table(spark, folder, "customer")
    lines = intervals(spark, folder)
    return {
        "orders": (
            orders,
            [
                ck.RowCountBetween(None, 1000, 200000000),
                ck.ColumnCount(None, 5),
                ck.ColumnExists("data_value"),
                ck.ColumnExists("stratification_value"),
                ck.ValuesBetween("year", 1995, 2001),
                ck.ValuesInSet("location_abbr", ("FF", "OO")),
                ck.ValuesMatch("location_abbr", "^[A-Z]{2}$"),
                ck.ValuesNotNull("data_value"),
                ck.ValuesUnique("record_id"),
                ck.ValuesUnique("customer_id"),
            ],
        ),
        "customer": (
            customer,
            [
                ck.RowCountBetween(None, 100, 200000000),
                ck.ValuesNotNull("c_name"),
                ck.ValuesUnique("c_custkey"),
            ],
        ),
        "lineitem": (
            lines,
            [ck.ValuesNotNull("price"), ck.NoFailedRows("confidence_interval_logic", OUTSIDE)],
        ),
    }


SUITES = union(
    rows_line("orders", "orders", 1000, 200000000),
    fixed_line("orders", "expect_table_column_count_to_equal", None, "(SELECT count(*) FROM orders)", 5, "true"),
    fixed_line("orders", "expect_column_to_exist", "data_value", "(SELECT count(*) FROM orders)", 1, "true"),
    fixed_line("orders", "expect_column_to_exist", "stratification_value", "(SELECT count(*) FROM orders)", 0,
               "false"),
    value_line("orders", "expect_column_values_to_be_between", "year", REPORTED,
               "year NOT BETWEEN 1995 AND 2001", "count(year)"),
    value_line("orders", "expect_column_values_to_be_in_set", "location_abbr", REPORTED,
               "location_abbr NOT IN ('FF', 'OO')", "count(location_abbr)"),
    value_line("orders", "expect_column_values_to_match_regex", "location_abbr", REPORTED,
               "NOT regexp_matches(location_abbr, '^[A-Z]{2}$')", "count(location_abbr)"),
    value_line("orders", "expect_column_values_to_not_be_null", "data_value", REPORTED, "data_value IS NULL"),
    unique_line("orders", "record_id", REPORTED),
    unique_line("orders", "customer_id", REPORTED),
    rows_line("customer", "customer", 100, 200000000),
    value_line("customer", "expect_column_values_to_not_be_null", "c_name", "customer", "c_name IS NULL"),
    unique_line("customer", "c_custkey", "customer"),
    value_line("lineitem", "expect_column_values_to_not_be_null", "price", INTERVALS, "price IS NULL"),
    value_line("lineitem", "failed_rows", "confidence_interval_logic", INTERVALS, OUTSIDE),
)


@query(SUITES)
def suite_results(spark, folder):
    return comparable(suites.run_suites(all_suites(spark, folder)))


@query(f"""
SELECT dataset, count(*) AS total, count(*) FILTER (WHERE success) AS successful,
  count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS success
FROM ({SUITES}) GROUP BY dataset
""")
def suite_summary(spark, folder):
    return suites.summarise(suites.run_suites(all_suites(spark, folder))).drop("run_ts")


@query(f"""
SELECT dataset, expectation, "column", success, bool_and(success) OVER (PARTITION BY dataset) AS overall_pass
FROM ({SUITES})
""")
def overall_pass(spark, folder):
    results = suites.with_overall_pass(suites.run_suites(all_suites(spark, folder)))
    return results.select("dataset", "expectation", "column", "success", "overall_pass")


YAML_SUITES = f"""
checks for orders:
  - row_count between 50 and 500000000
  - missing_count(record_id) = 0
  - missing_count(data_value) = 0
  - invalid_count(year) = 0:
      valid min: 1996
      valid max: 2024
  - invalid_count(location_abbr) = 0:
      valid length: 2
  - invalid_count(data_value) = 0:
      valid min: 0
checks for lineitem:
  - failed rows:
      name: confidence_interval_logic
      fail condition:
        {OUTSIDE}
"""


@query(union(
    rows_line("orders", "orders", 50, 500000000, "row_count"),
    value_line("orders", "missing_count", "record_id", REPORTED, "record_id IS NULL"),
    value_line("orders", "missing_count", "data_value", REPORTED, "data_value IS NULL"),
    value_line("orders", "invalid_count", "year", REPORTED, "year NOT BETWEEN 1996 AND 2024", "count(year)"),
    value_line("orders", "invalid_count", "location_abbr", REPORTED, "length(location_abbr) <> 2",
               "count(location_abbr)"),
    value_line("orders", "invalid_count", "data_value", REPORTED, "data_value < 0", "count(data_value)"),
    value_line("lineitem", "failed_rows", "confidence_interval_logic", INTERVALS, OUTSIDE),
))
def yaml_suite_results(spark, folder):
    batches = {"orders": reported_orders(spark, folder), "lineitem": intervals(spark, folder)}
    loaded = yaml_checks.load_suites(YAML_SUITES)
    parts = [suites.run_suite(batches[name], checks, name) for name, checks in loaded.items()]
    return comparable(reduce(DataFrame.unionByName, parts))


@query(value_line("lineitem", "expect_column_values_to_be_in_set", "low_le_high",
                  f"(SELECT coalesce(low <= high, false) AS low_le_high FROM {INTERVALS})", "NOT low_le_high"))
def check_true_flag(spark, folder):
    flagged = with_interval_flag(intervals(spark, folder), "low", "high")
    return single(flagged, "lineitem", ck.TrueFlag("low_le_high"))


@query("""
WITH early AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE year(o_orderdate) < 1996),
late AS (SELECT o_custkey, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1996)
""" + union(*[f"""
SELECT 'orders' AS dataset, 'expect_column_values_to_be_in_set' AS expectation, '{c}' AS "column",
  count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM early)) = 0 AS success, CAST(NULL AS DOUBLE) AS observed,
  count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM early)) AS unexpected_count,
  round(100.0 * count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM early)) / count({c}), 6) AS unexpected_pct
FROM late""" for c in ("o_custkey", "o_orderpriority")]))
def check_categories(spark, folder):
    """Customers and priorities of later orders must be known from earlier ones; the customers are many."""
    orders = table(spark, folder, "orders")
    early = F.year("o_orderdate") < 1996
    learned = ck.learn_categories(orders.filter(early), ["o_custkey", "o_orderpriority", "absent"])
    return single(orders.filter(~early), "orders", *learned)


CURATED_ORDERS = Dataset(
    name="orders",
    raw=T.StructType([T.StructField(n, T.StringType()) for n in ("RecordId", "CustomerId", "Year", "DataValue", "LocationAbbr")]),
    year="year",
    rows_expected=(1, 10),
    rows_by_rule=(1, 10),
    rows_curated=(1_000, 200_000_000),
    metric_max=None,
    has_limits=False,
    keys=("record_id",),
    learned=("data_value",),
    categories=("location_abbr",),
    unique=("record_id",),
)
LATE = f"(SELECT * FROM {REPORTED} WHERE year >= 1996)"
EARLY = f"(SELECT * FROM {REPORTED} WHERE year < 1996)"


@query(union(
    *[x for c in ("record_id", "customer_id", "year", "data_value", "location_abbr") for x in (
        fixed_line("orders", "expect_column_to_exist", c, f"(SELECT count(*) FROM {LATE})", 1, "true"),
        value_line("orders", "expect_column_values_to_not_be_null", c, LATE, f"{c} IS NULL"))],
    rows_line("orders", LATE, 1_000, 200_000_000),
    value_line("orders", "expect_column_values_to_be_between", "data_value", LATE,
               f"data_value NOT BETWEEN (SELECT min(data_value) FROM {EARLY}) AND (SELECT max(data_value) FROM {EARLY})",
               "count(data_value)"),
    value_line("orders", "expect_column_values_to_be_in_set", "location_abbr", LATE,
               f"location_abbr NOT IN (SELECT location_abbr FROM {EARLY} WHERE location_abbr IS NOT NULL)",
               "count(location_abbr)"),
    unique_line("orders", "record_id", LATE),
    fixed_line("orders", "expect_table_column_count_to_equal", None, f"(SELECT count(*) FROM {LATE})", 5, "true"),
))
def config_suite(spark, folder):
    """A suite from the configuration of a dataset, with ranges and categories of an earlier batch."""
    orders = reported_orders(spark, folder)
    late = orders.filter("year >= 1996")
    return single(late, "orders", *CURATED_ORDERS.curated_checks(late, baseline=orders.filter("year < 1996")))


RUN_FILES = union(*[f"""
SELECT '{name}' AS dataset, TIMESTAMP '{run}' AS run_ts, CAST(3 AS BIGINT) AS total,
  CAST(1 AS BIGINT) + CAST(count(*) >= {least} AS BIGINT) + CAST(min(o_totalprice) >= {low} AS BIGINT) AS successful,
  CAST(3 AS BIGINT) - 1 - CAST(count(*) >= {least} AS BIGINT) - CAST(min(o_totalprice) >= {low} AS BIGINT) AS failed,
  count(*) >= {least} AND min(o_totalprice) >= {low} AS success,
  CASE WHEN NOT (count(*) >= {least} AND min(o_totalprice) >= {low}) THEN '{name}.csv' END AS failed_file
FROM orders WHERE o_orderstatus = '{status}'"""
    for run, least, low in (("2024-01-01 00:00:00", 1, 0), ("2024-01-02 12:30:00", 1_000_000_000, 1e9))
    for name, status in (("finished", "F"), ("open", "O"))])


@query(RUN_FILES)
def run_summary(spark, folder):
    """Two runs over the files of a folder: counts per batch and the file of a batch that failed."""
    root = new_folder(spark, "batches")
    orders = table(spark, folder, "orders")
    for name, status in (("finished", "F"), ("open", "O")):
        sinks.write_csv(orders.filter(F.col("o_orderstatus") == status), f"{root}/{name}.csv")
    files = [f"{root}/{name}.csv" for name in ("finished", "open")]
    reports = new_folder(spark, "reports")
    for run, least, low in ((datetime(2024, 1, 1), 1, 0), (datetime(2024, 1, 2, 12, 30), 1_000_000_000, 1e9)):
        suite = [ck.RowCountBetween(None, least, 10**12), ck.ValuesBetween("o_totalprice", low), ck.ColumnExists("o_orderkey")]
        suites.validate_files(
            spark, files, lambda spark, path: scan.read_csv(spark, path, orders.schema), lambda _: suite, reports, run
        )
    found = suites.run_summary(suites.read_reports(spark, reports))
    return found.withColumn("failed_file", F.regexp_extract("failed_file", "[^/]*$", 0))


@query("""
WITH yearly AS (
  SELECT year(o_orderdate) AS y, count(*) AS row_count, avg(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END) AS null_rate
  FROM orders WHERE NOT (year(o_orderdate) = 1998 AND o_orderstatus = 'F') GROUP BY 1),
runs AS (SELECT * FROM yearly WHERE y IN (1997, 1998))
SELECT 'orders' AS dataset, b.row_count, a.row_count AS prev_row_count,
  round((a.row_count - b.row_count) / CAST(a.row_count AS DOUBLE), 6) AS drop_ratio,
  round(b.null_rate - a.null_rate, 6) AS null_rate_rise,
  (a.row_count - b.row_count) / CAST(a.row_count AS DOUBLE) > 0.10 AS volume_alarm,
  b.null_rate - a.null_rate > 0.05 AS null_rate_alarm
FROM runs a JOIN runs b ON a.y = 1997 AND b.y = 1998
""")
def drift_from_reports(spark, folder):
    """A run per year is validated and stored; the newest is compared with the one before from the stored reports."""
    orders = reported_orders(spark, folder).filter("NOT (year = 1998 AND coalesce(location_abbr, '') = 'FF')")
    reports = new_folder(spark, "reports")
    for year in (1995, 1996, 1997, 1998):
        batch = orders.filter(F.col("year") == year)
        checks = [ck.RowCountBetween(None, 1, 10**12), ck.ValuesNotNull("data_value")]
        suites.validate(spark, {"orders": (batch, checks)}, reports, datetime(year, 12, 31))
    history = drift.run_history(suites.read_newest_reports(spark, reports))
    compared = drift.compare_runs(history, newest_only=True)
    rounded = {c: F.round(c, 6) for c in ("drop_ratio", "null_rate_rise")}
    return compared.withColumns(rounded).drop("run_ts", "null_rate", "prev_null_rate")


@query(f"""
SELECT dataset, bool_and(success) AS success, count(*) AS results FROM ({SUITES}) GROUP BY dataset
""")
def report_documents(spark, folder):
    """Results as one JSON document per dataset and run, read back."""
    documents = suites.as_documents(suites.run_suites(all_suites(spark, folder)))
    read = F.from_json("document", "success boolean, results array<struct<success: boolean>>")
    return documents.select("dataset", read.alias("read")).select(
        "dataset", "read.success", F.size("read.results").cast("bigint").alias("results")
    )
