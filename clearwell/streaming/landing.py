"""Landing new CSV files only, so that a run costs what arrived since the last one."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F, types as T

from clearwell.sources.scan import CSV_QUOTING


def land_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    bronze: str,
    progress: str,
    files_per_batch: int = 10_000,
) -> None:
    """Append the files that ``progress`` does not know yet to the bronze table, then stop.

    A large backlog is worked off in batches, so an interrupted run goes on from the last of them.
    ``progress`` is the checkpoint folder of the stream; with it every file lands exactly once even
    if the job is interrupted. It belongs on storage that all executors share. Files count as new
    whatever their time stamp, so it keeps the names of all files that have landed.
    """
    reader = spark.readStream.options(**CSV_QUOTING, enforceSchema=False, maxFilesPerTrigger=files_per_batch)
    # By default a file much older than the newest one is skipped.
    reader = reader.option("maxFileAge", "36500d")
    arrivals = reader.schema(schema).csv(landing)
    query = (
        arrivals.select("*", F.col("_metadata.file_name").alias("source_file"))
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
