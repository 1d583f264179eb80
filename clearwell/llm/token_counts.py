"""Token counts from a digest cache.

The cache is a table of ``(content, tokenizer, n_bytes, n_tokens)``. Contents that it lacks for
this tokenizer are encoded once each and appended to it; every document then finds its count by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has
from clearwell.llm.tokenizing import encoder, tokenizer_version
from clearwell.session import new_folder

CACHE_SCHEMA = "content binary, tokenizer string, n_bytes long, n_tokens long"


def content_digest(text: Column) -> Column:
    """Digest of the normalised content: NULL counts as empty; nothing that could change a count is altered."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts; an empty table where nothing was stored yet."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _encode(texts: DataFrame, file: str) -> DataFrame:
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(file)
        for batch in batches:
            yield pd.DataFrame({
                "content": batch["content"], "n_bytes": batch["n_bytes"],
                "n_tokens": [len(encode(t)) for t in batch["text"]],
            })

    return texts.mapInPandas(counted, "content binary, n_bytes long, n_tokens long")


def fill_cache(documents: DataFrame, path: str, file: str, text: str = "text") -> None:
    """Append the counts of all contents that the cache at ``path`` lacks for this tokenizer.

    Copies are merged inside each task before texts are shuffled, so a text that a third of the
    documents share is moved once per task and encoded once. A retried or repeated append is harmless:
    readers take one row per content.
    """
    spark = documents.sparkSession
    version = tokenizer_version(file)
    known = read_cache(spark, path).where(F.col("tokenizer") == version).select("content")
    body = F.coalesce(F.col(text), F.lit(""))
    contents = documents.select(
        content_digest(F.col(text)).alias("content"), F.octet_length(body).cast("long").alias("n_bytes"),
        body.alias("text"),
    )
    missing = contents.dropDuplicates(["content"]).join(known, "content", "left_anti")
    counts = _encode(missing, file).withColumn("tokenizer", F.lit(version))
    counts.select("content", "tokenizer", "n_bytes", "n_tokens").write.mode("append").parquet(path)


def token_counts(documents: DataFrame, cache: str | None = None, file: str = "byte_bpe_50k.json",
                 key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every document.

    NULL and empty texts have no bytes and no tokens. Repeated rows are each returned. An empty table
    gives an empty result. Other columns are not read. Without ``cache`` a new one is started in the shared folder.
    """
    has(documents, key=key, text=text)
    spark = documents.sparkSession
    cache = cache or new_folder(spark, "token-cache")
    fill_cache(documents, cache, file, text)
    stored = read_cache(spark, cache).where(F.col("tokenizer") == tokenizer_version(file))
    stored = stored.groupBy("content").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))
    asked = documents.select(F.col(key), content_digest(F.col(text)).alias("content"))
    return asked.join(stored, "content").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
