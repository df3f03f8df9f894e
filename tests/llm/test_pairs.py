"""Near-duplicates of vectors and texts, repeated passages, benchmark passages: against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pluvia.llm.decontamination import contaminated_documents
from pluvia.llm.embedding_dedup import near_duplicate_vectors, plan, signatures
from pluvia.llm.graph import components, forest
from pluvia.llm.simhash import blocks_for, dealt_to_shards, fingerprint, linked_fingerprints, near_duplicate_groups, plant, route, search
from pluvia.llm.substring_dedup import remove_repeats

DOCS = "doc_id long, text string"


def groups(ids, pairs):
    top = forest(pairs)
    return {i: top.get(i, i) for i in ids}


def test_components_of_a_long_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (7000, 6000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert got == groups(ends, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    x = [b + rng.standard_normal(16) * s for b in base for s in (0, 0, 0.05, 0.12, 0.3)]
    rows = [(i, [float(c) for c in np.float32(v)], i % 3) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, rows[0][1], None), (905, [1.0, 2.0], 0), (906, [], 0), (907, [float("inf")] + [1.0] * 15, 0)]
    rows.append(rows[0])  # a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("x")).withColumn("size", F.lit(1))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df, block_rows=8).collect())
    good = [r for r in rows if r[1] and r[2] is not None and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1])]
    links, pairs = [0] * len(good), []
    for a in range(len(good)):
        for b in range(a):
            if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]):
                p, q = np.array(good[a][1]), np.array(good[b][1])
                if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    pairs.append((good[a][0], good[b][0]))
    top = groups([r[0] for r in rows], [p for p in pairs if p[0] != p[1]])
    n_links = {r[0]: n for r, n in zip(good, links, strict=True)}
    assert sum(links) > 50
    assert got == sorted((r[0], n_links.get(r[0], 0), top[r[0]], top[r[0]] == r[0]) for r in rows)


def test_comparisons_of_vectors_grow_less_than_their_square():
    rng = np.random.default_rng(6)

    def met(n):
        unit = rng.standard_normal((n, 64))
        sig = signatures(unit / np.linalg.norm(unit, axis=1, keepdims=True), *plan(n, 0.93), 7)
        return sum(int((c * (c - 1) // 2).sum()) for t in sig.T for c in [np.unique(t, return_counts=True)[1]])

    small, large = met(2000), met(8000)
    assert large < 6 * small and large < 0.01 * 8000 * 8000 / 2


def test_tables_find_pairs_at_the_threshold():
    rng = np.random.default_rng(7)
    for n in (500, 5000, 100_000):
        x = rng.standard_normal((600, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal((600, 64))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        how = (*plan(n, 0.93), 7)
        hit = (signatures(x, *how) == signatures(0.93 * x + np.sqrt(1 - 0.93**2) * y, *how)).any(axis=1)
        assert hit.mean() >= 0.99


def test_vectors_with_null_and_repeated_ids(spark):
    a, near, far, lone = [1.0, 0.0, 0.2], [1.0, 0.05, 0.2], [0.0, 1.0, 0.0], [-1.0, 0.3, 0.3]
    rows = [(None, a, 1), (None, a, 1), (7, near, 1), (9, near, 1), (7, far, 1), (3, far, 1), (None, lone, 1), (None, None, 1)]
    rows += [(None, [1.0, 0.01 * k, 0.2], 1) for k in range(1, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in near_duplicate_vectors(df).collect()]
    assert len(got) == len(rows)
    assert sorted(r for r in got if r[0] is not None) == [(3, 1, 3, True), (7, 1, 3, False), (7, 22, 7, True), (9, 22, 7, False)]
    nulls = [r[1:] for r in got if r[0] is None]
    assert nulls.count((22, 7, False)) == 21 and nulls.count((0, None, True)) == 2 and len(nulls) == 23


def test_vectors_of_one_large_group_of_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), F.lit(1).alias("label"))
    got = near_duplicate_vectors(df).agg(F.min("n_links"), F.max("n_links"), F.max("component_id"), F.count_if("kept")).first()
    assert tuple(got) == (2999, 2999, 0, 1)
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def naive_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One two", "É a\x0bB\x0cc d\x85e", "w " * 500, "x y z " + "Ab cd " * 3000])
def test_fingerprint(text):
    assert fingerprint(text, 3, 42) == naive_fingerprint(text)


def test_simhash_groups_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(vocab, k=rnd.choice([3, 40, 200]))) for _ in range(150)]
    texts += [t.replace("w1 ", "w2 ", 1).upper() for t in texts] + [None, "", "  "]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(1, texts[0]), (None, texts[1])]
    df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(0)).withColumn("rep", F.lit("x")).withColumn("component_id", F.lit(0))
    got = sorted(near_duplicate_groups(df, shard_rows=16).collect(), key=str)
    fps = [naive_fingerprint(t) for _, t in rows]
    pairs = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if rows[a][0] is not None and rows[b][0] is not None and (fps[a] ^ fps[b]).bit_count() <= 3]
    top = groups([r[0] for r in rows if r[0] is not None], [p for p in pairs if p[0] != p[1]])
    assert sorted((r[0], f"{f:016x}") for r, f in zip(rows, fps, strict=True) if r[0] is not None) == sorted((r["doc_id"], r["fingerprint"]) for r in got if r["doc_id"] is not None)
    assert all(r["component_id"] == top[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert len(got) == len(rows) and near_duplicate_groups(df.limit(0)).count() == 0


def test_simhash_work_grows_with_the_rows(spark):
    made, by = {}, blocks_for(3)
    for n in (2000, 8000):
        rng = np.random.default_rng(n)
        fp = rng.integers(0, 2**63, n, dtype="uint64").view("int64").tolist()
        prints = spark.createDataFrame([(x,) for x in fp], "fp long")
        dealt = dealt_to_shards(prints, by, shard_rows=64, sample_rows=64, seed=1)
        got = dealt.groupBy("tree", "shard").agg(F.count_if("live").alias("m"), F.count("*").alias("q")).collect()
        assert sum(r["m"] for r in got) == n * len(by) and max(r["m"] for r in got) <= 4 * 64  # every print lives once in each tree
        made[n] = sum(-(-r["m"] // 256) * r["q"] for r in got)
    assert made[8000] < 8 * made[2000]  # with a depth that stops, 16 times
    assert [(m.bit_count(), r) for m, r in blocks_for(3, 4)] == [(16, 0)] * 4 and [r for _, r in blocks_for(3)] == [1, 1] and [r for _, r in blocks_for(2)] == [1, 0]


@pytest.mark.parametrize("how", [{"shard_rows": 4, "sample_rows": 32}, {"blocks": 4}, {"blocks": 1, "shard_rows": 8}])
def test_links_of_prints_by_any_trees(spark, how):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 150, dtype="uint64")
    fp = np.concatenate([base, base ^ np.uint64(7), base[:60] ^ np.uint64((1 << 62) | 4), np.arange(40, dtype="uint64")])
    fp = np.unique(fp)
    rows = spark.createDataFrame([(int(x),) for x in fp.view("int64")], "fp long")
    got = forest((r["a"], r["b"]) for r in linked_fingerprints(rows, **how).collect())
    pairs = [(int(x), int(y)) for x in fp.view("int64") for y in fp[np.bitwise_count(fp ^ np.uint64(int(x) % 2**64)) <= 3].view("int64") if x != y]
    assert got == forest(pairs)


def test_tree_search_finds_every_close_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 800, dtype="uint64")
    fp = np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), base[:50] ^ np.uint64(0x8000000100000001)])
    want = {(int(a), int(b)) for a, x in enumerate(fp) for b in np.flatnonzero(np.bitwise_count(fp ^ x) <= 3)}
    low = (1 << 32) - 1
    found = set()
    for mask in (low, low << 32):
        m, q = search(fp, fp, mask, 1, 3, leaf=16)
        found |= set(zip(m.tolist(), q.tolist(), strict=True))
        tree = plant(fp[::7], mask, 4, rng)
        live = np.zeros(len(fp), int)
        for _, rows, own in route(fp, tree, mask, 1):
            live[rows[own]] += 1
        assert (live == 1).all()
    assert found == want


def naive_repeats(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first.get(tuple(w[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeats_against_brute_force(spark):
    rnd = random.Random(9)
    vocab = [f"é{i}" for i in range(60)]
    passages = [" ".join(rnd.choices(vocab, k=n)) for n in (12, 15, 30, 80)]
    rows = []
    for i in range(120):
        parts = [" ".join(rnd.choices(vocab, k=rnd.choice([0, 5, 40]))) for _ in range(3)]
        rows.append((i * 2, (" \n".join([parts[0], rnd.choice(passages), parts[1], rnd.choice(passages)[: rnd.choice([30, 200])], parts[2]]))))
    rows += [(500 + i, rows[3][1]) for i in range(20)] + [(700, None), (701, ""), (None, rows[3][1]), (4, rows[9][1]), (4, rows[2][1]), (702, "a a " * 400), (703, "a " * 300)]
    df = spark.createDataFrame(rows, DOCS).withColumn("copy", F.lit(1)).withColumn("w", F.lit(2)).withColumn("th", F.lit(3))
    got = sorted((tuple(r) for r in remove_repeats(df, window=12, shard_bytes=3000).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == naive_repeats(rows, 12)
    assert sum(r[2] > 0 for r in got) > 50
    assert remove_repeats(df.limit(0)).count() == 0


def test_decontamination_tolerates_substitutions(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    items = [[word() for _ in range(n)] for n in (40, 25, 14, 6, 1)]
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(10, " ".join(items[0])), (11, None), (12, "...")]
    filler = lambda n: [word() for _ in range(n)]
    changed = lambda x, step: [word() if k % step == step - 1 else w for k, w in enumerate(x)]
    rows = [
        (0, filler(50) + items[0] + filler(20)), (1, filler(9) + changed(items[0], 7) + filler(3)), (2, filler(30)), (3, items[1][:8] + filler(30)), (4, changed(items[1], 3)),
        (5, items[2]), (6, filler(5) + items[3] + filler(5)), (7, items[3][:5] + filler(4)), (8, filler(4) + items[4]), (9, []),
    ]
    rows = [(i, ", ".join(w).upper()) for i, w in rows] + [(20, None), (0, "again nothing"), (None, " ".join(items[2])), (None, "clean words")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit(1)).withColumn("item", F.lit("x")).withColumn("hits", F.lit(0))
    got = contaminated_documents(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    found = sorted(((r["doc_id"], r["item_ids"]) for r in got), key=str)
    assert found == sorted([(0, [0, 10]), (0, []), (1, [0, 10]), (2, []), (3, []), (4, []), (5, [2]), (6, [3]), (7, []), (8, [4]), (9, []), (20, []), (None, [2]), (None, [])], key=str)
    assert all(r["contaminated"] == bool(r["item_ids"]) and r["n_items"] == len(r["item_ids"]) for r in got)
    none = contaminated_documents(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.where("contaminated").count() == 0 and none.count() == len(rows)
    assert contaminated_documents(docs.limit(0), spark.createDataFrame(bench, "item_id long, text string")).count() == 0
