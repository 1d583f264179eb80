"""Writers, and checks on what was written."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clearwell.operators.keyvalue import BATCH_ITEMS
from clearwell.sources.scan import CSV_QUOTING, read_csv, read_if_present, read_parquet

# Fixed value: rows per insert of a relational load.
INSERT_ROWS = 5000


def write_csv(df: DataFrame, path: str) -> str:
    """Replace the CSV folder; one file per task, never funnelled into one.

    Blanks around a value are written as they are; left alone, the writer would trim them.
    """
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**CSV_QUOTING, **keep_blanks).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, max_rows_per_file: int = 0) -> str:
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    return path


def load_relational(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Replace a database table. Each of the ``connections`` tasks inserts in batches; the number
    is bounded by what the database accepts, not by the size of the input. The rows are dealt out to
    them by a shuffle: the writer alone would run all of the plan before it in as few tasks."""
    settings = {"batchsize": str(INSERT_ROWS), "numPartitions": str(connections)}
    df.repartition(connections).write.jdbc(url, table, mode="overwrite", properties={**settings, **(properties or {})})


def load_files(
    spark: SparkSession,
    tables: Mapping[str, str],
    load: Callable[[DataFrame, str], None],
    required: bool = False,
) -> list[str]:
    """Load a path-to-table map of CSV files; missing files are skipped unless ``required``."""
    loaded = []
    for path, table in tables.items():
        df = read_if_present(lambda: read_csv(spark, path), path, required)
        if df is not None:
            load(df, table)
            loaded.append(table)
    return loaded


def write_items(
    items: DataFrame,
    put_batch: Callable[[list[dict]], None],
    item: str = "item",
    size: int = BATCH_ITEMS,
) -> int:
    """Send JSON items to a key-value store and return how many were written.

    ``put_batch`` runs in the tasks with up to ``size`` items, numbers as decimals, and must replace
    items by key: a task that is retried sends its items again. The total counts each task once.
    """

    def send(arrow_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (text for part in arrow_batches for text in part.column(0).to_pylist())
        written = 0
        for chunk in batched(texts, size):
            put_batch([json.loads(text, parse_float=Decimal) for text in chunk])
            written += len(chunk)
        yield pa.RecordBatch.from_pydict({"written": [written]})

    sent = items.select(item).mapInArrow(send, "written bigint")
    return sent.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    df.show(n)
    return df


def write_and_verify(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write, read back and compare: one row with rows and columns on both sides.

    The rows sent are counted by the writing job itself, so the input is evaluated once.
    """
    sent = Observation()
    observed = df.observe(sent, F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    if fmt == "csv":
        back = read_csv(spark, write_csv(observed, path), df.schema)
    else:
        back = read_parquet(spark, write_parquet(observed, path), df.schema)
    rows = sent.get["n"]
    return back.agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit(rows).cast("bigint").alias("rows_written"),
        "rows_read",
        F.lit(len(df.columns)).cast("bigint").alias("columns_written"),
        F.lit(len(back.columns)).cast("bigint").alias("columns_read"),
        (F.col("rows_read") == rows).alias("complete"),
    )
