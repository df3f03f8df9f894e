"""Ids above 2^53 stay exact beside nulls in one partition."""

import pytest
import public_tokenizers
from pyspark.sql import functions as F

from pluvia.llm import queries  # noqa: F401  (the registered forms import)
from pluvia.llm.embedding_dedup import near_duplicate_vectors
from pluvia.llm.html_text import extract_text
from pluvia.llm.metric_tree import largest_products
from pluvia.llm.quality import quality_scores
from pluvia.llm.simhash import near_duplicate_groups
from pluvia.llm.sstable import read_token_table, write_token_table
from pluvia.llm.substring_dedup import remove_repeats
from pluvia.llm.toxicity import ToxicityModel, score_toxicity

IDS = [None, 2**60 + 1, 2**60 + 3]


def with_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    return quality_scores(docs.withColumn("host", F.lit("h")), labels, F.col("host"), F.col("host"))


CASES = {
    "op1": lambda s, d: near_duplicate_vectors(d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.col("n")).alias("embedding"), F.lit(1).alias("label"))).select("vec_id"),
    "op2": lambda s, d: remove_repeats(d).select("doc_id"),
    "op3": lambda s, d: near_duplicate_groups(d).select("doc_id"),
    "op5": lambda s, d: extract_text(d.withColumnsRenamed({"doc_id": "page_id", "text": "html"})).select("page_id"),
    "op7": lambda s, d: read_token_table(write_token_table(d, public_tokenizers.path("word_bpe_49k.json"), 2)).select("doc_id"),
    "op8": lambda s, d: with_labels(s, d).select("doc_id"),
    "op9": lambda s, d: score_toxicity(d, ToxicityModel({}, -1.0, 0.1)).select("doc_id"),
}


@pytest.mark.parametrize("name", CASES)
def test_large_ids_beside_nulls(spark, name):
    docs = spark.createDataFrame([(i, f"word{k} other{k}", float(k)) for k, i in enumerate(IDS)], "doc_id long, text string, n double").coalesce(1)
    assert sorted((r[0] for r in CASES[name](spark, docs).collect()), key=lambda x: x or 0) == IDS


def test_large_ids_name_their_own_groups(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (2**60 + 1, "x y z w"), (2**60 + 3, "k l m n"), (2**60 + 5, "k l m n")], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicate_groups(docs).collect()}
    assert got == {None: None, 2**60 + 1: 2**60 + 1, 2**60 + 3: 2**60 + 3, 2**60 + 5: 2**60 + 3}


def test_large_ids_in_searches(spark):
    rows = [(None, [1.0, 0.0]), (2**60 + 24, [1.0, 0.0]), (2**60 + 25, [0.5, 0.0])]  # 2^60 + 24 is divisible by 100
    got = [tuple(r) for r in largest_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)).orderBy("rank").collect()]
    assert (2**60 + 24) % 100 == 0 and got == [(2**60 + 24, 1, None, 1024 * 1024), (2**60 + 24, 2, 2**60 + 25, 512 * 1024)]
