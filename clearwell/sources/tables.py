"""Layer tables by path, and declared tables in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from clearwell.operators.columns import col, conform, misfit_reasons
from clearwell.session import discard, stage


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the table at ``path``. ``fmt="delta"`` works where its jar is on the classpath."""
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def save_named_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace a catalog table that keeps its files at ``path``."""
    df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _column_ddl(field: T.StructField) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def external_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Declare a table over files that are already there; the schema is applied on reading."""
    columns = ", ".join(_column_ddl(f) for f in schema)
    settings = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        + (f"OPTIONS ({settings}) " if settings else "")
        + f"LOCATION '{path}'"
    )
    return spark.table(name)


def truncate_and_load(
    df: DataFrame, name: str, path: str, schema: T.StructType, rejects: str | None = None, reason: str = "reason"
) -> DataFrame:
    """Create the declared table if need be and replace its rows by the conformed input.

    The columns go in by declared order. Running it twice leaves the same rows. A cell that does not fit its
    column fails the load, unless ``rejects`` names a folder: then the rows that do not fit are written there as they
    came, with the ``reason``, and the others are loaded. The input is evaluated once and staged, as an overwrite empties
    the table before the first row is computed: a load that fails leaves the table as it was.
    """
    external_table(df.sparkSession, name, path, schema)
    if rejects is None:
        checked = stage(conform(df, schema, strict=True), "load-checked")
        checked.write.insertInto(name, overwrite=True)
    else:
        if reason in df.columns:
            raise ValueError(f"the input has a column {reason!r} of its own")
        checked = stage(df.withColumn(reason, misfit_reasons(df, schema)), "load-checked")
        write_table(checked.filter(col(reason).isNotNull()), rejects)
        conform(checked.filter(col(reason).isNull()), schema).write.insertInto(name, overwrite=True)
    discard(checked)
    return df.sparkSession.table(name)
