"""Recall of the search for benchmark passages against brute-force alignment, over random and all substitutions."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from pluvia.llm.decontamination import BLOCK, MASKS, MORE_MASKS, Benchmark, contaminated_documents, item_masks, overlap


def naive_items(text, items):
    doc, out = re.findall(r"[^\W_]+", (text or "").lower()), []
    for i, item in items:
        n = min(24, len(item))
        for shift in range(-len(item), len(doc) + 1):
            same = [0 <= k + shift < len(doc) and doc[k + shift] == w for k, w in enumerate(item)]
            if any(10 * sum(same[s : s + n]) >= (7 if len(item) >= 12 else 10) * n for s in range(len(item) - n + 1)):
                out.append(i)
                break
    return out


@pytest.mark.parametrize("n", range(12, 25))
def test_masks_hit_every_accepted_pattern(n):
    masks = [int(m, 2) << s for m in item_masks(n) for s in range(n - len(m) + 1)]
    for changed in itertools.combinations(range(n), n - math.ceil(0.7 * n - 1e-9)):
        gone = sum(1 << k for k in changed)
        assert any(not m & gone for m in masks), changed


def test_longer_items_need_no_more_masks():
    assert item_masks(24) == item_masks(500) == list(MASKS) and item_masks(23) == item_masks(500, window=20) == [*MASKS, *MORE_MASKS]


@pytest.mark.parametrize("bitmap_keys", [4_000_000, 0])
def test_substitutions_against_brute_force(spark, bitmap_keys):
    rnd = random.Random(4)
    vocab = ["w" + "".join(rnd.choices("abcdefghij", k=4)) for _ in range(60)]
    items = [(i, rnd.choices(vocab, k=n)) for i, n in enumerate([3, 8, *range(12, 30), 40, 60])]
    rows = []
    for i in range(150):
        own = list(rnd.choice(items)[1])
        for k in rnd.sample(range(len(own)), round(rnd.uniform(0, 0.4) * len(own))):
            own[k] = rnd.choice(vocab)
        rows.append((i, " ".join(rnd.choices(vocab, k=rnd.randrange(30)) + own + rnd.choices(vocab, k=rnd.randrange(30)))))
    rows += [(200, " ".join(w for k, w in enumerate(items[4][1][:11]))), (201, None)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = contaminated_documents(spark.createDataFrame(rows, "doc_id long, text string"), bench, bitmap_keys=bitmap_keys).collect()
    want = {i: naive_items(t, items) for i, t in rows}
    assert {r["doc_id"]: r["item_ids"] for r in got} == want and sum(map(bool, want.values())) > 60


def words_of(texts):
    h = [np.array([hash(w) % 2**63 for w in t], dtype="uint64") for t in texts]
    return np.concatenate(h), np.repeat(np.arange(len(h)), [len(x) for x in h]), np.cumsum([0, *map(len, h)]), h


def test_long_items_are_verified_by_blocks():
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(30)]
    items = [rnd.choices(vocab, k=n) for n in (12, 20, 24, 63, 64, 65, 130, 400)]
    docs = [[]]
    for i in range(400):
        own = list(rnd.choice(items))
        begin = rnd.randrange(len(own))
        own = [w if rnd.random() > 0.25 else rnd.choice(vocab) for w in own[begin : begin + rnd.randrange(10, 60)]]
        docs.append(rnd.choices(vocab, k=rnd.randrange(4)) + own + rnd.choices(vocab, k=rnd.randrange(4)) if i % 9 else [])
    h, doc, first, own = words_of(docs)
    bench = Benchmark([(i, x.tobytes()) for i, x in enumerate(words_of(items)[3])])
    want = {
        (d, t) for d, x in enumerate(own) for t, y in enumerate(words_of(items)[3])
        if any(overlap(x, y, shift, 24, 0.7) for shift in range(-len(y), len(x) + 1))
    }
    assert bench.found(h, doc, first, 24, 0.7) == want and len(want) > 80


def test_alignments_of_repeated_passages_are_verified_once():
    rnd = random.Random(9)
    passage = rnd.choices([f"w{i}" for i in range(5000)], k=48)
    items = [passage[i : i + 40] for i in range(8)]
    docs = [rnd.choices(passage, k=3) + passage + [f"x{i}"] for i in range(50)]
    h, doc, _, _ = words_of(docs)
    bench = Benchmark([(i, x.tobytes()) for i, x in enumerate(words_of(items)[3])])
    block, lies = bench.aligned(h, doc)
    assert len(block) <= 1.1 * 8 * 50 and BLOCK >= 40


def test_items_without_ids_count_by_their_text(spark):
    a, b, c = ([f"{x}{i}" for i in range(15)] for x in "abc")
    bench = spark.createDataFrame([(None, " ".join(a)), (None, " ".join(b)), (3, " ".join(c)), (3, " ".join(c)), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(a + b + c)), (2, " ".join(c)), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_items"], r["item_ids"]) for r in contaminated_documents(docs, bench).collect()}
    assert got == {1: (True, 3, [None, None, 3]), 2: (True, 1, [3]), 3: (False, 0, [])}


def test_the_passage_at_three_quarters_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id = 1699")
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").where("item_id = 130")
    assert contaminated_documents(docs, bench).first()["item_ids"] == [130]
