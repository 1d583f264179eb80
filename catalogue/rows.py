"""Filters, replacements, dedupe, ranking and key-value items."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.cleaning import NATION_CODES, nation_code
from catalogue.registry import query, table
from clearwell.operators import keyvalue, ranking, rows
from clearwell.plans.curate import EXCLUDED_LOCATIONS, UNIT_SPELLINGS


def located_customers(spark, folder):
    """Customers with a location code, unknown for one market segment."""
    known = F.col("c_mktsegment") != "FURNITURE"
    return table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.when(known, nation_code("c_nationkey")).alias("location_abbr")
    )


@query(f"""
SELECT c_custkey, c_name, substr('{NATION_CODES}', 3 * c_nationkey + 1, 2) AS location_abbr
FROM customer
WHERE c_mktsegment <> 'FURNITURE'
  AND substr('{NATION_CODES}', 3 * c_nationkey + 1, 2) NOT IN ('PR', 'GU', 'VI', 'AS', 'MP', 'US')
""")
def filter_exclude_set(spark, folder):
    return rows.exclude_codes(located_customers(spark, folder), "location_abbr", EXCLUDED_LOCATIONS)


def priced_orders(spark, folder):
    """Orders with a metric that is NULL for some and NaN for others."""
    priority = F.col("o_orderpriority")
    metric = F.when(priority == "1-URGENT", F.lit(float("nan"))).when(
        priority != "5-LOW", F.col("o_totalprice")
    )
    return table(spark, folder, "orders").select("o_orderkey", metric.alias("data_value"))


@query("""
SELECT o_orderkey, o_totalprice AS data_value FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
""")
def drop_null_metric(spark, folder):
    return rows.drop_missing(priced_orders(spark, folder), ["data_value"])


@query("""
SELECT count(*) AS n_rows,
  count(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END) AS n_metric
FROM orders
""")
def metric_guard(spark, folder):
    guarded = rows.require_metric(priced_orders(spark, folder), "data_value")
    return guarded.agg(F.count(F.lit(1)).alias("n_rows"), F.count("data_value").alias("n_metric"))


@query("""
SELECT o_orderkey,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'cases per 1,000' WHEN '5-LOW' THEN '%'
    ELSE 'cases per 100,000' END AS data_value_unit
FROM orders
""")
def replace_values(spark, folder):
    priority = F.col("o_orderpriority")
    unit = (
        F.when(priority == "1-URGENT", "per 100,000")
        .when(priority == "2-HIGH", "  cases per 100,000")
        .when(priority == "3-MEDIUM", "per 100,000 population")
        .when(priority == "4-NOT SPECIFIED", " cases per 1,000 ")
        .otherwise("%")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", unit.alias("data_value_unit"))
    return rows.replace_values(orders, "data_value_unit", UNIT_SPELLINGS)


@query("SELECT DISTINCT p_type AS level FROM part")
def category_levels(spark, folder):
    return rows.category_levels(table(spark, folder, "part"), "p_type")


@query("SELECT DISTINCT text, lang, source FROM documents")
def dedupe_rows(spark, folder):
    return rows.dedupe(table(spark, folder, "documents").select("text", "lang", "source"))


@query("""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
  CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)
""")
def duplicate_count(spark, folder):
    return rows.duplicate_count(table(spark, folder, "documents").select("text", "lang"))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def head_sample(spark, folder):
    return rows.head_rows(table(spark, folder, "orders"), ["o_orderkey"], 100)


LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def ranked_lines(spark, folder):
    """Three groups, each with a third of all rows."""
    return table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice", *LINE_TIES)


LINE_RANK = """row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS LAST,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate)"""
LINE_COLUMNS = "l_returnflag, l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate"


@query(f"SELECT {LINE_COLUMNS}, CAST({LINE_RANK} AS BIGINT) AS row_num FROM lineitem")
def rank_by_value(spark, folder):
    return ranking.rank_by_value(
        ranked_lines(spark, folder), "l_returnflag", "l_extendedprice", LINE_TIES
    )


@query(f"""
SELECT * FROM (SELECT {LINE_COLUMNS}, CAST({LINE_RANK} AS BIGINT) AS row_num FROM lineitem)
WHERE row_num <= 10
""")
def topk_per_group(spark, folder):
    return ranking.top_k(
        ranked_lines(spark, folder), 10, "l_returnflag", "l_extendedprice", LINE_TIES
    )


@query("""
WITH keyed AS (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus <> 'P'
)
SELECT o_orderkey AS record_id, CAST(floor((n - 1) / 25) AS BIGINT) AS batch_no,
  '{"record_id":' || o_orderkey || ',"location_abbr":"' || o_orderstatus || '","year":' || year(o_orderdate)
  || CASE WHEN o_orderpriority <> '5-LOW' THEN ',"data_value":' || CAST(o_totalprice AS VARCHAR) ELSE '' END
  || ',"loaded":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' AS item
FROM keyed
""")
def kv_items(spark, folder):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    metric = F.when(priority != "5-LOW", F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.when(status != "P", status).alias("location_abbr"),
        F.year("o_orderdate").cast("string").alias("year"),
        metric.alias("data_value"),
        F.col("o_orderdate").alias("loaded"),
    )
    made = keyvalue.items(orders, ["location_abbr", "year"], whole=["year"])
    return keyvalue.batch_numbers(made.select("record_id", "item"), ["record_id"])
