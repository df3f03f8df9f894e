"""A training-corpus pipeline over the documents table: five stages, each one operator of pluvia.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's
docs. All but the last return documents with all their columns. Dropped rows are joined back by broadcast only
while they are few (size checked), else by shuffle.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm.common import saved, small
from pluvia.llm.decontamination import contaminated_rows
from pluvia.llm.graph import components
from pluvia.llm.mixing import mixed_rows
from pluvia.llm.near_copies import similar_links
from pluvia.llm.simhash import fingerprint_rows, linked_fingerprints
from pluvia.llm.sstable import read_token_table, write_token_table
from pluvia.llm.toxicity import fit_toxicity, toxicity_of

TOXIC = 0.3


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without the given rows: doc_id and th, the hash of the text. Ids alone don't name a row: they may be null or repeat."""
    dropped = small(saved(rows.select(F.col("doc_id").alias("_i"), F.col("th").alias("_t")).distinct(), "dropped"))
    return docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["_i"]) & (F.xxhash64(docs["text"]) == dropped["_t"]), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays under the threshold; the model learns from this input's labelled rows."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity_of("text", model) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest id, null last, and of its texts the one with the smallest hash.

    Groups are linked by fingerprints within 3 bits and by a Jaccard similarity of at least 0.8 of five-word shingles.
    Of rows that are equal in id and text one stays.
    """
    marked = fingerprint_rows(docs)
    texts = saved(marked.select("th", "fp").distinct(), "texts")
    a, b = (texts.select(F.col("th").alias(s), F.col("fp").alias(f"{s}_fp")) for s in "ab")
    similar = similar_links(docs).join(a, "a").join(b, "b").select("a_fp", "b_fp")
    roots = saved(components(saved(linked_fingerprints(marked).union(similar), "all-links")), "roots")
    rows = marked.join(roots, F.col("fp") == F.col("node"), "left").select("id", "th", F.coalesce("component", "fp").alias("root"))
    rows = saved(rows.groupBy("id", "th", "root").count(), "rows")
    best = saved(rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("best")), "best")
    rest = rows.join(best, "root").where(~(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("th") == F.col("best.th"))))
    kept = _without(docs, rest.select(F.col("id").alias("doc_id"), "th"))
    again = small(saved(rows.where("count > 1").select(F.col("id").alias("_i"), F.col("th").alias("_t")), "repeated"))
    same = docs["doc_id"].eqNullSafe(again["_i"]) & (F.xxhash64(docs["text"]) == again["_t"])
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same, "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return _without(docs, contaminated_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times."""
    return mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what the token table holds."""
    return read_token_table(write_token_table(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_table", write_tokens),
]

#: The toxicity model and XXH64 fingerprints aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
