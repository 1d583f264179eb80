"""A corpus from raw documents to token shards, each stage one operator of ``clearwell.llm``.

Every stage works on what the one before kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm import decontamination, language, mixing, near_duplicates, training_order
from clearwell.llm.common import let_workers_import
from clearwell.session import new_folder, remove_folder, staging

#: No SQL: the model, the sketches and the permutation are not expressible in it.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike every language that the labelled documents teach, go."""
    let_workers_import(spark)
    model = language.fit(docs)
    found = docs.select(
        F.struct(*docs.columns).alias("row"), language.predict(spark, model, F.col("text")).alias("found")
    )
    return found.where("NOT found.rejected").select("row.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, a similarity of 0.8 or more."""
    let_workers_import(spark)
    return near_duplicates.deduplicate(docs, width=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    let_workers_import(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.remove(docs, benchmark, similarity=0.8, recall=0.95)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice stands there twice."""
    return mixing.mix_sources(docs, seed=42, cycle=(3, 1, 2), share=1.5, max_epochs=2.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order, and where each sequence of which document is."""
    let_workers_import(spark)
    return training_order.training_order(docs, seed=42, length=512)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources", mix),
    ("token-ID output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``.

    What a stage has staged goes when it is written, its own result when the next one is; the last result and the shards,
    whose folder it names, stay.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, name.lower().replace(" ", "-"))
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
