"""The pipeline: each stage's decisions, and the whole against the operators one by one."""

import corpus_pipeline as cp
from pyspark.sql import functions as F
from test_near_copies import naive_pairs

from pluvia.llm.decontamination import contaminated_documents
from pluvia.llm.graph import forest
from pluvia.llm.simhash import near_duplicate_groups

DATA = "/root/testdata/sf0.001"


def test_stages_keep_their_columns_and_decide(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("score", F.lit("x")).withColumn("_i", F.lit(0)).withColumn("_t", F.lit("y")).withColumn("th", F.lit(1)).withColumn("fp", F.lit(2))
    docs = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id = 4").withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(-1).cast("long"))).cache()
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "decontamination", "mixing", "token_table"]
    clean = cp.drop_toxic(spark, docs, DATA)
    assert clean.columns == docs.columns and 0.7 * docs.count() < clean.count() <= docs.count()
    once = cp.drop_near_duplicates(spark, docs, DATA)
    bits = [(r["doc_id"], r["component_id"]) for r in near_duplicate_groups(docs).collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    top = forest([b for b in bits if b[0] != b[1]] + naive_pairs(rows))
    assert once.columns == docs.columns and sorted(r[0] for r in once.select("doc_id").collect()) == sorted({top.get(i, i) for i, _ in rows})
    safe = cp.decontaminate(spark, docs, DATA)
    bad = {r[0] for r in contaminated_documents(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).where("contaminated").select("doc_id").collect()}
    assert safe.columns == docs.columns and bad and {r[0] for r in docs.select("doc_id").collect()} - bad == {r[0] for r in safe.select("doc_id").collect()}
    assert cp.mix(spark, docs, DATA).columns == docs.columns


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, DATA).cache()
    want = sorted(map(tuple, docs.collect()))
    got = sorted(map(tuple, cp.run(spark, DATA).collect()))
    assert got == want and [r[1] for r in sorted(got, key=lambda r: r[1])][0] == 0
