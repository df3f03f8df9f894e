"""Near copies by word shingles, and the pipeline's stage on them, against brute-force Jaccard similarity."""

import random

import corpus_pipeline as cp
from pyspark.sql import functions as F

from pluvia.llm import near_copies
from pluvia.llm.graph import forest
from pluvia.llm.near_copies import similar_links
from pluvia.llm.simhash import fingerprint


def naive_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def naive_pairs(rows):
    held = [(i, naive_shingles(t)) for i, t in rows if i is not None and len(naive_shingles(t))]
    return [(i, j) for k, (i, x) in enumerate(held) for j, y in held[:k] if i != j and 5 * len(x & y) >= 4 * len(x | y)]


def made_rows():
    rnd = random.Random(7)
    vocab = [f"é{i}X" for i in range(400)]
    rows = []
    for i in range(60):
        words = rnd.choices(vocab, k=rnd.choice([5, 6, 12, 60, 300]))
        for copy in range(4):
            own = list(words)
            for _ in range(rnd.randint(0, max(1, len(own) // 30)) if copy else 0):
                own[rnd.randrange(len(own))] = rnd.choice(vocab)
            rows.append((10 * i + copy, "  ".join(own).upper() if copy == 2 else "\n".join(own)))
    return rows + [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, "w " * 30), (905, "w " * 40), (None, rows[0][1]), rows[1]]


def test_links_join_what_brute_force_joins(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keys", F.lit(1)).withColumn("same", F.lit("x"))
    hashed = {r["th"]: r["text"] for r in df.select("text", F.xxhash64("text").alias("th")).collect()}
    norm = lambda t: tuple((t or "").encode().lower().split())
    got = {tuple(sorted((norm(hashed[r["a"]]), norm(hashed[r["b"]])))) for r in similar_links(df).collect()}
    want = {tuple(sorted((norm(a), norm(b)))) for a, b in naive_pairs([(t, t) for _, t in rows])}
    want = {(a, b) for a, b in want if a != b}
    assert got <= want and len(got) > 15 and forest(got) == forest(want)
    assert similar_links(df.limit(0)).count() == 0


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """300 copies of one text, each with its own changes: near the original, partly near each other."""
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4, 7])):
            own[rnd.randrange(200)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    seen, plain = [], near_copies.saved
    monkeypatch.setattr(near_copies, "saved", lambda df, name: seen.append((name, plain(df, name))) or seen[-1][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r["th"]: r["text"] for r in df.select("text", F.xxhash64("text").alias("th")).collect()}
    got = forest((hashed[r["a"]], hashed[r["b"]]) for r in similar_links(df).collect())
    assert got == forest(naive_pairs([(t, t) for _, t in rows]))
    assert sum(t.count() for name, t in seen if name == "pairs") < 300 * 299 / 2 / 3


def test_the_stage_drops_all_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    marks = [fingerprint(t, 3, 42) for _, t in rows]
    near = naive_pairs(rows)
    within = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 3]
    missed_by_bits = [p for p in near if forest(within).get(p[0], p[0]) != forest(within).get(p[1], p[1])]
    top = forest(near + within)
    # null and repeated ids: rows are known by their texts too
    assert sorted(map(tuple, cp.drop_near_duplicates(spark, spark.createDataFrame([(1, "a b c"), (4, "A  b c"), (4, "one of its own"), (7, "a b c"), (None, "a b c"), (None, "another"), (None, None), (7, "x"), (7, "x"), (6, "")], "doc_id long, text string"), "").collect()), key=str) == sorted([(1, "a b c"), (4, "one of its own"), (None, "another"), (7, "x"), (6, "")], key=str)
    got = sorted(r[0] for r in cp.drop_near_duplicates(spark, docs, "").select("doc_id").collect())
    assert missed_by_bits and got == sorted(i for i, _ in rows if top.get(i, i) == i)
