"""Token counts through a stored cache of (content digest, tokenizer digest)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import lean, new_path, saved, small
from pluvia.llm.tokens import encode, forget, version_digest, wordwise

_CACHE = "content string, n_tokens long, tokenizer string"


def _counts(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [len(ids) // 4 for ids in encode(batch["text"], path)]
            yield pd.DataFrame({"content": batch["content"], "n_tokens": n})
        forget()

    return run


def _rows(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    normal = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")) if wordwise(tokenizer) else text
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), normal.alias("text"))
    return rows.withColumn("content", F.sha2(F.col("text"), 256))


def _stored(spark, cache_path: str, version: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_CACHE).parquet(cache_path).where(F.col("tokenizer") == version)


def fill_cache(docs: DataFrame, tokenizer: str, cache_path: str, text_col: str = "text") -> None:
    """Counts the distinct contents that the cache lacks and appends them; Spark's committer leaves no part of a lost task.

    A cache with counts of this tokenizer is asked by digest first, and only texts it lacks go on: none, where all are stored.
    """
    spark, version = docs.sparkSession, version_digest(tokenizer)
    known, cache = _rows(docs, tokenizer, text_col, text_col).select("content", "text"), _stored(spark, cache_path, version)
    if cache is not None and not cache.isEmpty():
        missing = saved(known.select("content").distinct().join(cache.select("content").distinct(), "content", "left_anti"), "missing")
        if missing.isEmpty():
            return
        known = known.join(small(missing), "content", "left_semi")
    misses = known.groupBy("content").agg(F.first("text").alias("text"))
    found = misses.mapInPandas(lean(_counts(tokenizer)), "content string, n_tokens long").withColumn("tokenizer", F.lit(version))
    found.write.mode("append").partitionBy("tokenizer").parquet(cache_path)


def token_counts(
    docs: DataFrame, tokenizer: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Content is normalised only as far as the tokenizer ignores (white space for tokenizers that drop it, else nothing),
    digested with SHA-256 and joined to the counts stored at `cache_path` for this tokenizer file and library version.
    Only distinct contents that the cache lacks are encoded; their counts are appended to it (`fill_cache`).
    Without a path a new cache is begun in the shared folder.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids keep one row each. Empty input: no rows.
    """
    spark = docs.sparkSession
    cache_path = cache_path or new_path(spark, "token-cache")
    fill_cache(docs, tokenizer, cache_path, text_col)
    cache = _stored(spark, cache_path, version_digest(tokenizer))
    # saved, so that the join below stands on plain exchanges and a content with very many rows can be split
    counts = saved(cache.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return _rows(docs, tokenizer, id_col, text_col).drop("text").join(counts, "content").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
