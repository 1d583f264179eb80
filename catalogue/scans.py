"""Readers and writers, on files that are first written from the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from catalogue.registry import query, table
from clearwell.session import new_folder
from clearwell.sources import scan, sinks, tables
from clearwell.streaming.landing import land_new_files


def released(df, name):
    """Rows of an external table whose name is given up: its files stay, and the analysed plan names them."""
    df.sparkSession.sql(f"DROP TABLE {name}")
    return df


def part_csv(spark, folder, spoil: bool = False) -> tuple[str, object]:
    """The part table as CSV, on request with text in a number column; returns path and schema."""
    part = table(spark, folder, "part")
    schema = part.schema
    if spoil:
        size = F.when(F.col("p_type") == "PROMO", "n/a").otherwise(F.col("p_size").cast("string"))
        part = part.withColumn("p_size", size)
    # Quotes and separators inside a cell must survive the trip.
    name = F.concat(F.lit('the "'), "p_name", F.lit('", new'))
    path = sinks.write_csv(part.withColumn("p_name", name), new_folder(spark, "part-csv"))
    return path, schema


@query("""
SELECT p_partkey, 'the "' || p_name || '", new' AS p_name, p_brand, p_type, p_size, p_retailprice
FROM part
""")
def scan_csv_typed(spark, folder):
    path, schema = part_csv(spark, folder)
    return scan.read_csv(spark, path, schema)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'the "' || p_name || '", new' AS p_name, p_brand,
  p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
""")
def scan_csv_strings(spark, folder):
    path, _ = part_csv(spark, folder)
    return scan.read_csv(spark, path)


@query("""
SELECT p_partkey, 'the "' || p_name || '", new' AS p_name, p_brand, p_type,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size END AS p_size, p_retailprice
FROM part
""")
def scan_csv_permissive(spark, folder):
    path, schema = part_csv(spark, folder, spoil=True)
    return scan.read_csv(spark, path, schema)


@query("""
SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_nationkey < 12 THEN s_acctbal END AS s_acctbal,
  CASE WHEN s_nationkey >= 12 THEN 'region, "' || s_nationkey || '"' END AS s_note
FROM supplier
""")
def scan_parts_union(spark, folder):
    """Parts of one folder that differ in their columns and in the order of them."""
    supplier = table(spark, folder, "supplier")
    note = F.concat(F.lit('region, "'), F.col("s_nationkey").cast("string"), F.lit('"')).alias("s_note")
    first = supplier.filter("s_nationkey < 12")
    second = supplier.filter("s_nationkey >= 12").select(note, "s_nationkey", "s_name", "s_suppkey")
    path = sinks.write_csv(first, new_folder(spark, "supplier-csv"))
    second.write.mode("append").options(**scan.CSV_QUOTING).csv(path)
    return scan.read_parts(spark, path, supplier.schema)


@query("SELECT * FROM customer")
def scan_parquet(spark, folder):
    """A whole prefix of files, as its schema is."""
    path = sinks.write_parquet(table(spark, folder, "customer"), new_folder(spark, "prefix"), max_rows_per_file=500)
    return scan.read_parquet(spark, path)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def scan_parquet_pruned(spark, folder):
    customer = scan.read_parquet(spark, f"{folder}/customer.parquet")
    return customer.filter("c_acctbal > 5000").select("c_custkey", "c_acctbal")


@query("""
SELECT 'parquet' AS kind, count(*) AS n_rows, true AS found FROM customer
UNION ALL SELECT 'csv', count(*), true FROM customer
UNION ALL SELECT 'optional', CAST(0 AS BIGINT), false
""")
def scan_listed_inputs(spark, folder):
    """Inputs found by their suffix below one folder, and an optional one that is not there."""
    root = new_folder(spark, "inputs")
    customer = table(spark, folder, "customer")
    sinks.write_parquet(customer, f"{root}/a", max_rows_per_file=500)
    sinks.write_csv(customer, f"{root}/b")
    counts = []
    readers = {
        "parquet": lambda files: spark.read.schema(customer.schema).parquet(*files),
        "csv": lambda files: scan.read_csv(spark, files, customer.schema),
    }
    for kind, read in readers.items():
        files = [r.path for r in scan.list_inputs(spark, root, f".{kind}").select("path").collect()]
        counts.append(read(files).agg(F.lit(kind).alias("kind"), F.count("*").alias("n_rows"), F.lit(True).alias("found")))
    path = f"{root}/none"
    absent = scan.read_if_present(lambda: scan.read_parquet(spark, path), path, required=False)
    missing = customer.limit(0) if absent is None else absent
    found = F.lit(absent is not None).alias("found")
    counts.append(missing.agg(F.lit("optional").alias("kind"), F.count("*").alias("n_rows"), found))
    return reduce(DataFrame.unionByName, counts)


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def named_tables_and_views(spark, folder):
    """A saved table and a view, joined by SQL under their names."""
    name = f"nation_{uuid.uuid4().hex}"
    tables.save_named_table(table(spark, folder, "nation"), name, new_folder(spark, "nation-table"))
    view = sinks.register_view(table(spark, folder, "region"), f"region_{uuid.uuid4().hex}")
    joined = spark.sql(f"SELECT n_nationkey, n_name, r_name FROM {name} JOIN {view} ON n_regionkey = r_regionkey")
    spark.sql(f"DROP TABLE {name}")  # its files stay, and the analysed plan names them
    return joined


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_date,
  o_orderpriority
FROM orders
""")
def roundtrip_csv(spark, folder):
    orders = table(spark, folder, "orders")
    path = sinks.write_csv(orders, new_folder(spark, "orders-csv"))
    return _with_day(scan.read_csv(spark, path, orders.schema))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_date,
  o_orderpriority
FROM orders
""")
def roundtrip_parquet(spark, folder):
    orders = table(spark, folder, "orders")
    path = sinks.write_parquet(orders, new_folder(spark, "orders-parquet"), max_rows_per_file=1_000_000)
    return _with_day(scan.read_parquet(spark, path, orders.schema))


def _with_day(orders):
    return orders.withColumn("o_date", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


@query("""
SELECT n AS rows_written, n AS rows_read, CAST(11 AS BIGINT) AS columns_written,
  CAST(11 AS BIGINT) AS columns_read, true AS complete
FROM (SELECT count(*) AS n FROM lineitem)
""")
def readback_check(spark, folder):
    return sinks.write_and_verify(table(spark, folder, "lineitem"), new_folder(spark, "lineitem"))


@query("""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_nationkey, CAST(NULL AS VARCHAR) AS c_phone
FROM customer
""")
def external_table_projection(spark, folder):
    declared = T.StructType.fromDDL("c_name STRING, c_nationkey INT, c_phone STRING, c_custkey BIGINT")
    name = f"customer_{uuid.uuid4().hex}"
    return released(tables.external_table(spark, name, f"{folder}/customer.parquet", declared), name)


@query("""
SELECT 'part' AS dataset, count(*) AS n_rows FROM part
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'customer', count(*) FROM customer
""")
def bronze_ingest(spark, folder):
    names = ["part", "supplier", "customer"]
    landing = {n: sinks.write_csv(table(spark, folder, n), new_folder(spark, f"{n}-landing")) for n in names}
    per_file = scan.ingest_landing(spark, landing, new_folder(spark, "bronze"))
    return per_file.groupBy("dataset").agg(F.sum("n_rows").alias("n_rows"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def bronze_ingest_incremental(spark, folder):
    supplier = table(spark, folder, "supplier")
    landing, bronze, progress = (new_folder(spark, f"supplier-{n}") for n in ("landing", "bronze", "progress"))
    for part in ("s_nationkey < 12", "s_nationkey >= 12"):
        arrived = supplier.filter(part)
        arrived.write.mode("append").options(**scan.CSV_QUOTING).csv(landing)
        land_new_files(spark, landing, supplier.schema, bronze, progress)
    return scan.read_parquet(spark, bronze).drop("source_file")


@query("""
SELECT c_mktsegment, CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer
""")
def truncate_load_conform(spark, folder):
    declared = T.StructType.fromDDL("c_mktsegment VARCHAR(20), c_custkey INT NOT NULL, c_name VARCHAR(25), c_acctbal DOUBLE, c_nationkey VARCHAR(10)")
    name, path = f"target_{uuid.uuid4().hex}", new_folder(spark, "target")
    customer = table(spark, folder, "customer")
    tables.truncate_and_load(customer, name, path, declared)
    return released(tables.truncate_and_load(customer, name, path, declared), name)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CASE WHEN c_nationkey = 3 THEN '12x' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
  CASE WHEN c_nationkey <> 4 THEN c_mktsegment END AS c_mktsegment,
  nullif(concat_ws('; ', CASE WHEN length(c_mktsegment) > 9 AND c_nationkey <> 4 THEN 'c_mktsegment: text longer than 9' END,
    CASE WHEN c_nationkey = 4 THEN 'c_mktsegment: must not be null' END,
    CASE WHEN c_nationkey = 3 THEN 'c_acctbal: no double' END), '') AS reason
FROM customer
""")
def truncate_load_rejects(spark, folder):
    """What was loaded, without a reason, and what was not, with one."""
    declared = T.StructType.fromDDL("c_mktsegment VARCHAR(9) NOT NULL, c_custkey INT, c_acctbal DOUBLE, c_name VARCHAR(25)")
    name, path, rejects = f"target_{uuid.uuid4().hex}", new_folder(spark, "target"), new_folder(spark, "rejects")
    nation = F.col("c_nationkey")
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.when(nation == 3, "12x").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(nation != 4, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    loaded = released(tables.truncate_and_load(customer, name, path, declared, rejects), name)
    as_text = loaded.select(*[F.col(c).cast("string").alias(c) for c in customer.columns], F.lit(None).cast("string").alias("reason"))
    return as_text.unionByName(tables.read_table(spark, rejects))
