"""Phrases, inner products and the prefix trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pluvia.llm import phrases, prefix_trie
from pluvia.llm.metric_tree import grow, largest_products, search
from pluvia.llm.phrases import collocations
from pluvia.llm.prefix_trie import conversation_trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_by_loops(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * c[q]}
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("parts", ["plain", "tiny"])
def test_phrases_against_loops(spark, monkeypatch, parts):
    if parts == "tiny":  # many chunks, and words and pairs that are dealt by more than their first word
        monkeypatch.setattr(phrases, "CHUNK_WORDS", 300)
        monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
        monkeypatch.setattr(phrases, "PARTITION_BYTES", 3000)
    rnd = random.Random(6)
    words = ["the", "The", "of", "É", "éa", "x y", "a-b", "naïve", "w'", "ﬁn", "\x85", "\x1c"]
    text = lambda: "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\x0b", "\n"]) for _ in range(rnd.randrange(0, 120)))
    rows = [(rnd.choice(["en", "en", "en", None, "fr x\ty", ""]), text()) for _ in range(150)]
    rows += [("en", None), ("en", ""), ("de", "..,"), ("en", "of the " * 900), ("en", "of the rare" + " of the" * 20), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("text", "lang", "1 AS f", "'q' AS phrase", "2 AS rank").repartition(3)
    for least, top in ((10, 2000), (2, 7)):
        got = sorted(tuple(r) for r in collocations(df, least, top).collect())
        assert got == phrases_by_loops(rows, least, top)
    assert len(got) > 20 and collocations(df.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 5_000_000_029, 7_000_000_001
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.selectExpr("1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) AS s").first()["s"]
    assert got == 1_000_000 * a * a // (left * right)


def best_by_loops(rows, k):
    fine = [(i, [int(np.floor(1024 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for n, (i, q) in enumerate(fine):
        if i is not None and i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j is None, j or 0) for m, (j, x) in enumerate(fine) if m != n and len(x) == len(q))[:k]
            out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(found, 1)]
    return sorted(out, key=repr)


def test_inner_products_against_loops(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(400)] + [(1000 + i, rng.standard_normal(3).tolist()) for i in range(120)]
    rows += [(2000 + i, rows[0][1]) for i in range(150)] + [(3000, [0.0] * 6), (3100, [1e5] * 6), (3200, [0.1]), (3300, []), (3301, []), (None, rows[5][1])]
    rows += [(4000, None), (4100, [None, 1.0]), (4200, [float("nan")] * 6), (4300, [float("inf")] * 6), rows[100], rows[100], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("embedding", "vec_id", "1 AS score", "2 AS dim", "3 AS rank").repartition(5)
    got = sorted((tuple(r) for r in largest_products(df, chunk_rows=40, page_rows=8).collect()), key=repr)
    assert got == best_by_loops(rows, 10)
    assert largest_products(df.limit(0)).count() == 0


def test_bounds_leave_products_out():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    v = np.floor(1024 * np.repeat(centres, 100, axis=0) + 60 * rng.standard_normal((4000, 16))).astype("int64")
    ids = np.arange(4000)
    middle, radius, pages = grow(v, ids, ids, 32)
    assert sorted(np.concatenate([p["key"] for p in pages if p["leaf"]]).tolist()) == ids.tolist()
    worked = 0
    for q in range(0, 4000, 97):
        found, n = search(pages, middle, radius, v[q], q, 10)
        s, worked = v @ v[q], worked + n
        assert found == [(int(s[i]), int(i), int(i)) for i in np.lexsort((ids, -s)) if i != q][:10]
    assert worked / 42 < 1000  # a quarter of the vectors


def trie_by_loops(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members, kids, below, out = defaultdict(list), defaultdict(list), {}, []
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        mine = (len(members[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        below[k] = (mine + sum(below[x][0] for x in kids[k]), sum(below[x][1] for x in kids[k]) or 1)
        ends = sorted(c for c in members[k] if len(rebuilt[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(members[k]), len(k), parent, len(members[k]), len(kids[k]), below[k][1], below[k][0], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rnd = random.Random(4)
    rows = [(c, rnd.choice([t, t, None]), rnd.choice(["u", "a", None]), rnd.choice(["x y", "", "z", None, "p q r"])) for c in [*range(70), -3, -21, 2**60 + 1, 200] for t in range(rnd.choice([1, 2, 3, 5, 9]))]
    rows += [(c, i, "u", f"long {i % 3}") for c, n in ((7, 150), (47, 140)) for i in range(n)]
    return [*rows, (None, 1, "u", "q"), (5, 1, "u", "s"), (5, 1, "u", "s")]


def test_trie_against_loops(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("text", "role", "turn", "conv_id", "1 AS depth", "2 AS f1", "3 AS row").repartition(3)
    got = sorted((tuple(r) for r in conversation_trie(df).collect()), key=repr)
    assert got == trie_by_loops(rows)
    assert conversation_trie(df.limit(0)).count() == 0


def test_colliding_fingerprints_are_found_and_made_anew(spark, monkeypatch):
    """With a weak base first (all prefixes of one turn's class sum alike), the checks ask for another."""
    asked, real = [], prefix_trie.bases

    def weak(attempt):
        asked.append(attempt)
        return (1, 1) if attempt == 0 else real(attempt)

    monkeypatch.setattr(prefix_trie, "bases", weak)
    rows = [(20, 0, "u", "a"), (20, 1, "u", "b"), (40, 0, "u", "b"), (40, 1, "u", "a"), (60, 0, "u", "a"), (60, 1, "u", "b")]
    got = sorted((tuple(r) for r in conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    assert got == trie_by_loops(rows) and asked == [0, 1]


def test_trie_where_a_conversation_ends_early_in_a_partition_of_many_batches(spark):
    """Later batches of a partition hold nothing of the conversation that goes on from the partition before."""
    rnd = random.Random(9)
    rows = [(c, i, rnd.choice(["u", "a", None]), rnd.choice(["x y", "", "z", None])) for c in [*range(45), 100, 121] for i in range(rnd.choice([1, 2, 3, 5, 40]))]
    held = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(held, ("5", "16"), strict=True):
            spark.conf.set(k, v)
        got = sorted((tuple(r) for r in conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == trie_by_loops(rows)
