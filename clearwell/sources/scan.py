"""Readers. None of them infers types unless asked to: a declared schema needs no extra pass."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clearwell.operators.columns import conform, pandas_nulls, storable_names
from clearwell.sources.tables import read_table, write_table

# Quotes inside a quoted cell are doubled, in the files that are read and in those written.
CSV_QUOTING = {"header": True, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    multiline: bool = False,
    bad_cells_as_null: bool = True,
    **options,
) -> DataFrame:
    """CSV with a header line.

    With a schema the cells are typed; without one all columns are text, unless ``infer`` pays for a
    pass that guesses types. The header of every file must match, so that no file with another
    column order is read into the wrong columns. ``multiline`` allows line breaks inside quotes, but
    then a file is read by one task, so it is off unless needed.
    """
    reader = spark.read.options(**CSV_QUOTING, enforceSchema=False, **options)
    reader = reader.option("multiLine", multiline)
    reader = reader.option("mode", "PERMISSIVE" if bad_cells_as_null else "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_csv_like_pandas(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options
) -> DataFrame:
    """CSV in which the texts that pandas treats as missing are NULL; all text, or typed by a schema
    whose columns are picked by name."""
    as_text = pandas_nulls(read_csv(spark, path, **options))
    return as_text if schema is None else conform(as_text, schema)


#: Split sizes at which every file is one split and every split a task of its own.
_FILE_PER_TASK = {"spark.sql.files.maxPartitionBytes": 1 << 50, "spark.sql.files.openCostInBytes": 1 << 50}


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of every file in a task; stops at the first batch, so the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def header_index(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> dict[tuple[str, ...], list[str]]:
    """The column lists of the CSV files under ``paths``, each with the files that begin with it.

    A task per file reads its first line and stops. The driver gets one line per file, no more than the list of
    files that a scan keeps there anyway. Files without a line are in no list.
    """
    given = {name: spark.conf.get(name, None) for name in _FILE_PER_TASK}
    for name, value in _FILE_PER_TASK.items():
        spark.conf.set(name, str(value))
    try:
        lines = spark.read.option("pathGlobFilter", pattern).text(paths)
        lines = lines.select(F.col("_metadata.file_path").alias("file"), "value")
        first = lines.mapInArrow(_first_lines, "file string, value string").collect()
    finally:
        for name, value in given.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    index: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(first):
        names = tuple(next(csv.reader([line.removeprefix("\ufeff")])))
        index.setdefault(names, []).append(unquote(file))
    return index


def read_parts(
    spark: SparkSession,
    folders: str | Iterable[str],
    schema: T.StructType | None = None,
    pattern: str = "part-*.csv",
) -> DataFrame:
    """All CSV parts of one or more folders, combined by column name.

    Parts may differ in their columns and their order, also inside a folder: files with the same header are read by
    one scan, and the scans are united by name. Columns that only some parts have are NULL for the others. With a schema
    its columns come first, typed, NULL where no part has them; others follow as text.
    """
    folders = [folders] if isinstance(folders, str) else list(folders)
    index = header_index(spark, folders, pattern)
    declared = {f.name: f for f in schema} if schema is not None else {}
    parts = [spark.createDataFrame([], schema)] if schema is not None else []
    for names, files in index.items():
        typed = [declared.get(n, T.StructField(n, T.StringType())) for n in names]
        parts.append(read_csv(spark, files, T.StructType(typed)))
    if not parts:
        raise FileNotFoundError(f"no {pattern} with a header under {folders}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def list_inputs(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Path, size and time of the files under ``folder`` that end with ``suffix``.

    The contents are not read. No file at all is an error.
    """
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=f"*{suffix}", recursiveFileLookup=True)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    if files.isEmpty():
        raise FileNotFoundError(f"no {suffix} files under {folder}")
    return files


def read_if_present(
    read: Callable[[], DataFrame], path: str, required: bool = True
) -> DataFrame | None:
    """Run a reader; a missing path raises FileNotFoundError, or gives None if it is optional."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise FileNotFoundError(f"{path} not found: run the step that writes it first") from error
        return None


def ingest_landing(
    spark: SparkSession, landing: Mapping[str, str], bronze: str, **options
) -> DataFrame:
    """Land CSV sources unchanged as text tables under ``bronze`` and count what arrived.

    Every table keeps the file each row came from. The result has one row per source and file; the
    counts read only that one column of the tables.
    """
    counts = []
    for name, path in landing.items():
        raw = read_if_present(lambda: read_csv(spark, path, **options), path)
        with_file = raw.select("*", F.col("_metadata.file_name").alias("source_file"))
        table = f"{bronze}/{name}"
        write_table(storable_names(with_file), table)
        landed = read_table(spark, table)
        counts.append(
            landed.groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("dataset"), "source_file", "n_rows")
        )
    return reduce(DataFrame.unionByName, counts)
