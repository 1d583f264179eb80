"""Column operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, table
from clearwell.functions import numbers, runs, text
from clearwell.operators import columns as cols
from clearwell.plans.standardise import FINAL_NAMES, UNUSED_COLUMNS


@query("""
SELECT l_orderkey AS order_key, l_partkey AS part_key, l_linenumber AS a1_b2,
  l_quantity AS http_server_load, l_extendedprice AS extended_price, l_returnflag AS data_value_unit,
  l_linestatus AS "race/_ethnicity", l_suppkey AS "age(years)"
FROM lineitem
""")
def rename_snake(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_partkey").alias(" part-Key"),
        F.col("l_linenumber").alias("A1B2"),
        F.col("l_quantity").alias("HTTPServer Load"),
        F.col("l_extendedprice").alias("_Extended__Price_"),
        F.col("l_returnflag").alias("Data_Value_Unit"),
        F.col("l_linestatus").alias("Race/Ethnicity"),
        F.col("l_suppkey").alias("Age(years)"),
    )
    return lines.transform(cols.strip_names).transform(cols.snake_names)


@query("""
SELECT p_partkey AS Part_Key, p_name AS Ageyears, p_brand AS Brand_code, p_type AS Typetext,
  p_size AS Sizecm
FROM part
""")
def sanitize_columns(spark, folder):
    part = table(spark, folder, "part").drop("p_retailprice")
    return cols.storable_names(part.toDF(" Part Key", "Age(years)", "Brand; code", "Type=text", "Size,cm "))


@query("""
SELECT c_custkey AS customer, c_name AS age_range, c_nationkey AS income_range,
  c_acctbal AS race_ethnicity, c_mktsegment AS stratification_value
FROM customer
""")
def rename_map(spark, folder):
    customer = table(spark, folder, "customer").toDF(
        "customer", "age(years)", "income", "race/_ethnicity", "stratification1"
    )
    return cols.rename_present(customer, FINAL_NAMES)


@query("""
SELECT p_partkey AS PartKey, p_name AS DataValueUnit, p_size AS StratificationCategoryID1 FROM part
""")
def drop_listed_columns(spark, folder):
    part = table(spark, folder, "part").toDF(
        "PartKey", "DataValueUnit", "Data_Value_Unit", "Topic", "StratificationCategoryID1",
        "StratificationID1",
    )
    return cols.drop_present(part, UNUSED_COLUMNS)


def sparse_customers(spark, folder):
    """Customers with an empty column, and one that only a few rows fill."""
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 9000, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_note"),
        F.when(F.col("c_nationkey") < 0, F.col("c_mktsegment")).alias("c_never"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN c_name END AS c_name,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal
FROM customer
""")
def drop_null_columns(spark, folder):
    return cols.drop_null_columns(sparse_customers(spark, folder))


@query("""
SELECT count(*) AS c_custkey, count(CASE WHEN c_acctbal > 9000 THEN c_name END) AS c_name,
  count(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END) AS c_acctbal,
  CAST(0 AS BIGINT) AS c_note, CAST(0 AS BIGINT) AS c_never
FROM customer
""")
def non_null_counts(spark, folder):
    return cols.non_null_counts(sparse_customers(spark, folder))


@query("""
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id, 'events' AS batch FROM events
""")
def batch_run_id(spark, folder):
    """The batch of a row is the file that it was read from."""
    return table(spark, folder, "events").select(
        "event_id",
        runs.run_label(F.col("ts")).alias("run_id"),
        runs.batch_name(F.col("_metadata.file_name")).alias("batch"),
    )


@query(r"""
WITH a AS (
  SELECT p_partkey, regexp_replace(p_brand || '-' || p_name || ' HTTPServer__' || p_type || 'A1B2_',
                                   '(.)([A-Z][a-z]+)', '\1_\2', 'g') AS t FROM part
)
SELECT p_partkey, trim(regexp_replace(lower(replace(replace(
    regexp_replace(t, '([a-z0-9])([A-Z])', '\1_\2', 'g'), ' ', '_'), '-', '_')), '__+', '_', 'g'), '_') AS snake
FROM a
""")
def snake_case_values(spark, folder):
    raw = F.concat("p_brand", F.lit("-"), "p_name", F.lit(" HTTPServer__"), "p_type", F.lit("A1B2_"))
    return table(spark, folder, "part").select("p_partkey", text.snake_text(raw).alias("snake"))


def padded_customers(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit("\t ")).alias("c_name"),
        F.concat(F.lit("\n \t"), F.lower("c_mktsegment"), F.lit(" of\tall \r\n\u00a0")).alias("c_mktsegment"),
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
    )


@query("""
SELECT c_custkey, c_name || chr(9) AS c_name,
  chr(10) || ' ' || chr(9) || lower(c_mktsegment) || ' of' || chr(9) || 'all ' || chr(13) || chr(10)
    || chr(160) AS c_mktsegment,
  CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer
""")
def trim_strings(spark, folder):
    return cols.trim_text(padded_customers(spark, folder))


@query("""
SELECT c_custkey, c_name, lower(c_mktsegment) || ' of' || chr(9) || 'all' AS c_mktsegment,
  CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer
""")
def strip_strings(spark, folder):
    return cols.strip_text(padded_customers(spark, folder))


@query("""
SELECT c_custkey, upper(c_mktsegment) || ' OF' || chr(9) || 'ALL' AS code FROM customer
""")
def upper_code(spark, folder):
    padded = padded_customers(spark, folder)
    return padded.select("c_custkey", text.upper_code(F.col("c_mktsegment")).alias("code"))


@query("""
SELECT c_custkey, concat(upper(left(c_mktsegment, 1)), lower(substr(c_mktsegment, 2)), ' of', chr(9), 'all')
  AS description
FROM customer
""")
def capitalize_text(spark, folder):
    padded = padded_customers(spark, folder)
    return padded.select("c_custkey", text.capitalize(F.col("c_mktsegment")).alias("description"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'N' THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CASE WHEN l_linestatus = 'O' THEN CAST(0 AS BIGINT) ELSE 9007199254740993 + l_orderkey END AS big
FROM lineitem
""")
def coerce_int(spark, folder):
    quantity = F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" "))
    )
    big = F.when(F.col("l_linestatus") == "O", F.lit("NaN")).otherwise(
        (F.lit(9007199254740993) + F.col("l_orderkey")).cast("string")
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", quantity.alias("quantity"), big.alias("big")
    )
    return cols.coerce(lines, whole=["quantity", "big", "absent"])


@query("""
SELECT o_orderkey,
  round(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 0
        ELSE CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END, 2) AS price
FROM orders
""")
def coerce_float(spark, folder):
    priority = F.col("o_orderpriority")
    as_text = (
        F.when(priority == "1-URGENT", "n/a")
        .when(priority == "2-HIGH", "NaN")
        .when(priority == "3-MEDIUM", F.concat(F.col("o_totalprice").cast("string"), F.lit("f")))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", as_text.alias("price"))
    coerced = cols.coerce(orders, floats=["price"])
    return coerced.withColumn("price", F.round(F.col("price").cast("double"), 2))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'N' THEN false
       ELSE l_extendedprice * (1 - l_discount) <= l_extendedprice * (1 + l_tax) - l_quantity END AS low_le_high
FROM lineitem
""")
def ci_flag(spark, folder):
    return cols.with_interval_flag(intervals(spark, folder), "low", "high").drop("low", "high", "price")


def intervals(spark, folder):
    """Prices between a discounted and a taxed price; the upper limit is short and often unknown."""
    price = F.col("l_extendedprice")
    high = price * (1 + F.col("l_tax")) - F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        price.alias("price"),
        (price * (1 - F.col("l_discount"))).alias("low"),
        F.when(F.col("l_returnflag") != "N", high).alias("high"),
    )


@query("""
WITH shown AS (
  SELECT o_orderkey, o_totalprice, CAST(o_totalprice AS VARCHAR) AS t FROM orders),
parts AS (
  SELECT *, split_part(t, '.', 1) AS whole, rtrim(split_part(t, '.', 2), '0') AS fraction FROM shown)
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 4)) AS price, CAST(o_totalprice AS DECIMAL(18, 4)) AS price_in_list,
  CAST(rtrim(whole || fraction, '0') AS BIGINT) AS digits,
  CAST(len(whole || fraction) - len(rtrim(whole || fraction, '0')) - len(fraction) AS INTEGER) AS exponent,
  CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 15 WHEN 2 THEN -25 WHEN 3 THEN 17976931348623157 WHEN 4 THEN 0 END
    AS extreme_digits,
  CAST(CASE o_orderkey % 6 WHEN 0 THEN 25 WHEN 1 THEN -21 WHEN 2 THEN -310 WHEN 3 THEN 292 WHEN 4 THEN 0 END AS INTEGER)
    AS extreme_exponent
FROM parts
""")
def float_to_decimal(spark, folder):
    """Prices, and numbers that no decimal type has room for."""
    extremes = F.array(*[F.lit(x) for x in (1e25, 1.5e-20, -2.5e-309, 1.7976931348623157e308, 0.0, float("nan"))])
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.array("o_totalprice").alias("prices"),
        F.struct(F.get(extremes, (F.col("o_orderkey") % 6).cast("int")).alias("value")).alias("extreme"),
    )
    exact = orders.withColumns(
        {c: numbers.to_decimal(F.col(c), orders.schema[c].dataType) for c in ("price", "prices")}
        | {"shown": numbers.to_exact(F.col("price"), orders.schema["price"].dataType)}
        | {"extreme": numbers.to_exact(F.col("extreme"), orders.schema["extreme"].dataType)}
    )
    return exact.select(
        "o_orderkey",
        F.col("price").cast("decimal(18,4)").alias("price"),
        F.col("prices")[0].cast("decimal(18,4)").alias("price_in_list"),
        "shown.digits", "shown.exponent",
        F.col("extreme.value.digits").alias("extreme_digits"),
        F.col("extreme.value.exponent").alias("extreme_exponent"),
    )
