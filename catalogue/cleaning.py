"""The two cleaners and the layered tables, on reports derived from orders and line items."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.registry import query, table
from clearwell.functions import numbers
from clearwell.plans.curate import curate
from clearwell.plans.layers import Layers, run_datasets
from clearwell.plans.standardise import standardise
from clearwell.session import new_folder
from clearwell.sources import scan, sinks

# One location code per nation; some are codes that curation drops.
NATION_CODES = "AL AK US AZ AR PR CA CO CT VI DC DE FL GU GA HI ID AS IL IN MP IA KS KY LA"


def nation_code(key: str):
    return F.substr(F.lit(NATION_CODES), F.col(key) * 3 + 1, F.lit(2))


def raw_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw reports: camel-case names, blanks, unknown locations and metrics, an empty
    column, several spellings of a unit, and urgent orders sent twice with different blanks."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").drop("c_name", "c_acctbal")
    nation = table(spark, folder, "nation").drop("n_regionkey")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    pads = F.when(priority == "1-URGENT", F.array(F.lit(""), F.lit("  "))).otherwise(F.array(F.lit("")))
    sent = joined.withColumn("pad", F.explode(pads))
    unlocated = (status == "O") & (F.col("c_mktsegment") == "FURNITURE")
    unit = (
        F.when(priority == "1-URGENT", F.concat("pad", F.lit("per 100,000")))
        .when(priority == "2-HIGH", "  cases per 100,000")
        .when(priority == "3-MEDIUM", "per 100,000 population")
        .when(priority == "4-NOT SPECIFIED", "cases per 1,000")
        .otherwise("%")
    )
    unknown = (status == "P") & (priority == "5-LOW")
    return sent.select(
        F.year("o_orderdate").cast("bigint").alias("YearStart"),
        F.when(~unlocated, nation_code("c_nationkey")).alias("LocationAbbr"),
        F.concat(F.lit(" "), "n_name", "pad").alias("LocationDesc"),
        F.concat("c_mktsegment", "pad").alias("Topic"),
        F.lit(None).cast("string").alias("Response"),
        unit.alias("DataValueUnit"),
        status.alias("DataValueType"),
        F.when(~unknown, F.col("o_totalprice")).alias("DataValue"),
        F.lit("~").alias("DataValueFootnoteSymbol"),
        F.concat(F.lit("as sent"), "pad").alias("DataValueFootnote"),
        F.col("o_orderkey").alias("RecordID"),
    )


CURATED = f"""
WITH sent AS (
  SELECT o.*, c_mktsegment, n_name, pad,
         CASE WHEN o_orderstatus = 'O' AND c_mktsegment = 'FURNITURE' THEN NULL
              ELSE substr('{NATION_CODES}', 3 * n_nationkey + 1, 2) END AS location_abbr
  FROM orders o
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN (VALUES (''), ('  ')) p(pad) ON pad = '' OR o_orderpriority = '1-URGENT'
), clean AS (
  SELECT DISTINCT
    CAST(year(o_orderdate) AS BIGINT) AS year_start, location_abbr,
    trim(' ' || n_name || pad) AS location_desc, trim(c_mktsegment || pad) AS topic,
    CASE o_orderpriority
      WHEN '4-NOT SPECIFIED' THEN 'cases per 1,000' WHEN '5-LOW' THEN '%'
      ELSE 'cases per 100,000' END AS data_value_unit,
    o_orderstatus AS data_value_type, o_totalprice AS data_value, o_orderkey AS record_id
  FROM sent
  WHERE location_abbr NOT IN ('PR', 'GU', 'VI', 'AS', 'MP', 'US')
    AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
)
SELECT *, CAST(row_number() OVER (PARTITION BY location_abbr
                                  ORDER BY data_value DESC NULLS LAST, record_id) AS BIGINT) AS row_num
FROM clean
"""


@query(CURATED)
def clean_curate(spark, folder):
    return curate(raw_reports(spark, folder), ties=["record_id"])


@query(CURATED)
def medallion_gold(spark, folder):
    layers = Layers(spark, new_folder(spark, "layers"))
    published = layers.run({"reports": raw_reports(spark, folder)}, partial(curate, ties=["record_id"]))
    return published["reports"]


def raw_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as raw measurements: untidy names, text numbers with junk, unknown limits, exact
    copies of returned finished lines and copies of first lines that differ in blanks."""
    lines = table(spark, folder, "lineitem")
    copied = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    pads = (
        F.when(copied, F.array(F.lit(""), F.lit("")))
        .when(F.col("l_linenumber") == 1, F.array(F.lit(""), F.lit(" \t")))
        .otherwise(F.array(F.lit("")))
    )
    sent = lines.withColumn("pad", F.explode(pads))
    year = F.year("l_shipdate").cast("string")
    price, unknown = F.col("l_extendedprice"), F.col("l_returnflag") == "N"
    return sent.select(
        year.alias("YearStart"),
        F.concat(year, F.lit(".0")).alias(" YearEnd "),
        F.concat("l_returnflag", "l_linestatus").alias("LocationAbbr"),
        F.lit("prices").alias("Topic"),
        F.lit("USD").alias("Data_Value_Unit"),
        F.when(unknown, "n/a").otherwise(price.cast("string")).alias("Data_Value"),
        (price * (1 - F.col("l_discount"))).alias("Low_Confidence_Limit"),
        F.when(~unknown, price * (1 + F.col("l_tax"))).alias("High_Confidence_Limit"),
        F.col("l_quantity").cast("string").alias("Sample_Size"),
        F.concat("pad", F.col("l_linenumber").cast("string")).alias("Age(years)"),
        F.col("l_linestatus").alias("Income"),
        F.col("l_returnflag").alias("Race/Ethnicity"),
        F.concat(F.lit("\tOverall "), "pad").alias("Stratification1"),
        F.lit("OVR").alias("StratificationID1"),
        F.lit("OVERALL").alias("StratificationCategoryId1"),
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_partkey").alias("PartKey"),
        F.col("l_suppkey").alias("SuppKey"),
    )


@query("""
WITH sent AS (
  SELECT lineitem.*, '' AS pad FROM lineitem
  UNION ALL SELECT lineitem.*, '' FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
  UNION ALL SELECT lineitem.*, 'x' FROM lineitem
            WHERE l_linenumber = 1 AND NOT (l_returnflag = 'R' AND l_linestatus = 'F')
), unique_rows AS (
  SELECT DISTINCT year(l_shipdate) AS y, l_returnflag, l_linestatus, l_linenumber, pad, l_orderkey,
    l_partkey, l_suppkey, l_quantity,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice END AS metric,
    l_extendedprice * (1 - l_discount) AS low,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice * (1 + l_tax) END AS high
  FROM sent
)
SELECT CAST(y AS BIGINT) AS year_start, CAST(y AS BIGINT) AS year_end,
  l_returnflag || l_linestatus AS location_abbr,
  round(CAST(CAST(coalesce(metric, 0) AS FLOAT) AS DOUBLE), 2) AS data_value,
  round(CAST(CAST(low AS FLOAT) AS DOUBLE), 2) AS low_confidence_limit,
  round(CAST(CAST(coalesce(high, 0) AS FLOAT) AS DOUBLE), 2) AS high_confidence_limit,
  CAST(l_quantity AS BIGINT) AS sample_size, CAST(l_linenumber AS VARCHAR) AS age_range,
  l_linestatus AS income_range, l_returnflag AS race_ethnicity, 'Overall' AS stratification_value,
  l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key
FROM unique_rows
""")
def clean_standardise(spark, folder):
    clean = standardise(raw_measurements(spark, folder))
    floats = ["data_value", "low_confidence_limit", "high_confidence_limit"]
    return clean.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in floats})


@query(f"""
WITH curated AS ({CURATED})
SELECT year_start, location_abbr, topic, data_value_type, data_value, record_id, NULL AS unreadable FROM curated
WHERE data_value_type <> 'O' OR record_id % 7 <> 0
UNION ALL
SELECT year_start, location_abbr, topic, data_value_type, NULL, record_id, '<' || CAST(data_value AS VARCHAR) FROM curated
WHERE data_value_type = 'O' AND record_id % 7 = 0
""")
def curate_text_metric(spark, folder):
    """Metrics as text, some with a sign that no number has: those rows are set apart, none is lost."""
    as_text = F.col("DataValue").cast("string")
    unsure = (F.col("DataValueType") == "O") & (F.col("RecordID") % 7 == 0)
    reports = raw_reports(spark, folder).withColumn("DataValue", F.when(unsure, F.concat(F.lit("<"), as_text)).otherwise(as_text))
    apart = new_folder(spark, "quarantine")
    curated = curate(reports, ties=["record_id"], quarantine=apart)
    common = ["year_start", "location_abbr", "topic", "data_value_type", "record_id"]
    read = curated.select(*common, "data_value", F.lit(None).cast("string").alias("unreadable"))
    kept = spark.read.parquet(apart).select(*common, F.lit(None).cast("double").alias("data_value"), F.col("data_value").alias("unreadable"))
    return read.unionByName(kept)


@query("""
SELECT 'orders' AS dataset, count(*) AS n_rows, count(*) FILTER (WHERE o_totalprice > 100000) AS n_large FROM orders
UNION ALL SELECT 'customer', count(*), count(*) FILTER (WHERE c_acctbal > 100000) FROM customer
""")
def run_all_datasets(spark, folder):
    """The runner over several sources, one of them optional and absent."""
    out = new_folder(spark, "standardised")
    sources = {
        sinks.write_csv(table(spark, folder, name).withColumnRenamed(metric, "DataValue"), new_folder(spark, f"{name}-raw")): f"{out}/{name}"
        for name, metric in (("orders", "o_totalprice"), ("customer", "c_acctbal"))
    }
    sources[f"{out}/absent-raw"] = f"{out}/absent"
    written = run_datasets(spark, sources, lambda df: standardise(df), sinks.write_parquet, required=False)
    counts = [
        scan.read_parquet(spark, path).agg(
            F.lit(path.rsplit("/", 1)[1]).alias("dataset"), F.count("*").alias("n_rows"),
            F.count_if(F.col("data_value") > 100000).alias("n_large"),
        )
        for path in written
    ]
    return counts[0].unionByName(counts[1])


@query("""
SELECT c_custkey AS year_start, CAST(c_nationkey AS BIGINT) AS year_end, c_acctbal AS data_value FROM customer
""")
def strict_years(spark, folder):
    """Years of the strict cleaner: missing ones become 0, and anything that is no whole number would raise."""
    years = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("year_start"),
        F.nullif(F.col("c_nationkey").cast("string"), F.lit("0")).alias("year_end"),
        F.col("c_acctbal").alias("data_value"),
    )
    return years.withColumns({c: numbers.whole_number_or_raise(F.col(c)) for c in ("year_start", "year_end")})
