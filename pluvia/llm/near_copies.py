"""Near copies of texts by word shingles: MinHash bands and rare shingles propose pairs, the exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import lean, saved, small
from pluvia.llm.graph import components
from pluvia.llm.words import mix, spaced, word_hashes

#: A pair at similarity 0.8 meets in none of 32 bands of 5 minima with probability (1 - 0.8^5)^32 = 3e-6; a closer one less often.
BANDS, ROWS = 32, 5
#: Words of 64 bits in a text's parity bits.
PARITIES = 8
_TIMES = np.random.default_rng(17).integers(1, 2**31, BANDS * ROWS, dtype="uint32") * np.uint32(2) + np.uint32(1)
_FACTORS = np.random.default_rng(19).integers(1, 2**63, (BANDS, ROWS), dtype="uint64") * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(23).integers(1, 2**63, BANDS, dtype="uint64")


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The distinct runs of `size` words; a shorter text is one run of all its words. Words as in simhash.fingerprint."""
    words = (text or "").encode().lower().split()
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(size)], strict=False))


def normal_digest(text: str | None) -> bytes:
    """128-bit hash of the text up to the case of A-Z and white space."""
    return xxhash.xxh3_128_digest(b" ".join((text or "").encode().lower().split()))


def _shingle_hashes(text: str | None, size: int) -> np.ndarray:
    h, _, _ = word_hashes((text or "").encode(), lower=True)
    return np.unique(spaced(h, tuple(range(size)), 29))


def bands(text: str | None, size: int) -> np.ndarray:
    """Band keys; none for texts below `size` words, whose near copies are equal texts."""
    s = _shingle_hashes(text, size)
    if not len(s):
        return np.zeros(0, dtype="int64")
    top, least = (s >> np.uint64(32)).astype("uint32"), np.full(len(_TIMES), 2**32 - 1, dtype="uint32")
    for at in range(0, len(top), 1024):
        least = np.minimum(least, (_TIMES[:, None] * top[None, at : at + 1024]).min(axis=1))
    keys = mix((least.astype("uint64").reshape(BANDS, ROWS) * _FACTORS).sum(axis=1, dtype="uint64") ^ _SALTS)
    return keys.view("int64")


def _signed(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"th": batch["th"], "same": [normal_digest(t) for t in batch["text"]], "keys": [bands(t, size) for t in batch["text"]]})

    return run


def _compared(size: int, tenths: int):
    """The pairs that reach the similarity; the texts of one hub mostly come one after another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, x = None, set()
        for batch in batches:
            keep = []
            for hub, s, t in zip(batch["hub"], batch["text_a"], batch["text_b"], strict=True):
                if hub != held:
                    held, x = hub, shingles(s, size)
                y = shingles(t, size)
                both = len(x & y)
                keep.append(10 * both >= tenths * (len(x) + len(y) - both))
            yield batch.loc[keep, ["hub", "th"]].set_axis(["a", "b"], axis=1)

    return run


def _tokens(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for th, text in zip(batch["th"].tolist(), batch["text"], strict=True):
                s = _shingle_hashes(text, size)
                yield pd.DataFrame({"th": th, "token": s.view("int64"), "n": np.full(len(s), len(s), dtype="int32")})

    return run


def _parities(size: int):
    """Per text, 512 bits: each tells whether an odd number of its shingles fall on it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            odd = [np.bincount((_shingle_hashes(t, size) >> np.uint64(7) & np.uint64(511)).astype(int), minlength=512) & 1 for t in batch["text"]]
            words = np.packbits(np.array(odd, dtype="uint8").reshape(-1, 512), axis=1).view("int64")
            yield pd.DataFrame({"th": batch["th"], **{f"p{k}": words[:, k] for k in range(PARITIES)}})

    return run


def _prefix_pairs(texts: DataFrame, tops: DataFrame, size: int, tenths: int) -> DataFrame:
    """(hub, th): pairs of different components that may reach the similarity, by their rarest shingles.

    The shingles of a text are ordered by how many texts have them. Two texts of n and m >= n shingles at similarity s share at
    least s / (1 + s) * (n + m) of them, so the first shared one is early in both: within n - 2 s / (1 + s) n of the smaller,
    m - s m of the larger, and with enough left behind it. Two texts differ in at least as many shingles as their parity
    bits differ, which rules out most others. Nothing is missed.
    """
    tokens = saved(texts.mapInPandas(lean(_tokens(size)), "th long, token long, n int"), "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1")
    mine = saved(tokens.join(saved(often, "often"), "token"), "shared")
    # shingles of one text only come first and have no partner
    w = Window.partitionBy("th")
    placed = mine.withColumn("pos", F.col("n") - F.count("*").over(w) + F.row_number().over(w.orderBy("freq", "token")) - 1)
    placed = placed.where(f"10 * pos <= {10 - tenths} * n").join(tops, F.col("th") == F.col("node"), "left")
    sketch = [f"p{k}" for k in range(PARITIES)]
    parity = saved(texts.mapInPandas(lean(_parities(size)), "th long, " + ", ".join(f"{p} long" for p in sketch)), "parities")
    placed = placed.join(small(parity), "th").select("token", "th", "n", "pos", F.coalesce("component", "th").alias("top"), *sketch)
    placed = saved(placed, "prefixes")
    small_side = placed.where(f"{10 + tenths} * pos <= {10 - tenths} * n")
    a, b = (x.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("th", "n", "pos", "top", *sketch)]) for x, s in ((small_side, "a"), (placed, "b")))
    fits = (
        f"(n_a < n_b or n_a = n_b and th_a < th_b) and 10 * n_a >= {tenths} * n_b and top_a <> top_b"
        f" and {10 + tenths} * least(n_a - pos_a, n_b - pos_b) >= {tenths} * (n_a + n_b)"
        f" and {10 + tenths} * ({' + '.join(f'bit_count({p}_a ^ {p}_b)' for p in sketch)}) <= {10 - tenths} * (n_a + n_b)"
    )
    return a.join(b, "token").where(fits).select(F.col("th_a").alias("hub"), F.col("th_b").alias("th")).distinct()


def similar_links(docs: DataFrame, text_col: str = "text", size: int = 5, tenths: int = 8) -> DataFrame:
    """(a, b): xxhash64 of two texts whose sets of `size`-word shingles have a Jaccard similarity of at least `tenths` / 10.

    The links join the texts that all such pairs would join, but a group of n texts makes about n links and not all its pairs.
    Texts fall into one bucket for each MinHash band. In each bucket one text is held against the others by their words.
    Where a bucket's texts aren't all linked then, pairs of different components follow by their rarest shingles (prefix filter,
    exact), and their words decide. A text that shares no bucket with a similar one is missed with probability 3e-6.

    Texts that are equal up to case and white space are compared once; they aren't linked here. Null and empty texts, and texts
    of fewer than `size` words, are in no pair. Repeated rows count once. Empty input: no rows.
    """
    rows = docs.select(F.col(text_col).alias("text")).where("text is not null").withColumn("th", F.xxhash64("text"))
    signed = saved(rows.mapInPandas(lean(_signed(size)), "th long, same binary, keys array<long>").where(F.size("keys") > 0), "bands")
    first = saved(signed.groupBy("same").agg(F.min("th").alias("th")), "first")
    one = signed.join(first, ["same", "th"], "left_semi").dropDuplicates(["same"])
    keyed = saved(one.select("th", F.explode("keys").alias("bucket")), "buckets")
    hubs = keyed.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("th", F.lit(1)), "th")).alias("h"), F.count("*").alias("c")).where("c > 1")
    hubs = saved(hubs.select("bucket", F.col("h.th").alias("hub")), "hubs")
    met = saved(keyed.join(small(hubs), "bucket").select("bucket", "hub", "th"), "members")
    texts = rows.join(small(saved(met.select("th").distinct(), "ends")), "th", "left_semi").dropDuplicates(["th"])
    texts = saved(texts, "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = saved(pairs, "pairs")
        sides = pairs.join(texts.withColumnRenamed("text", "text_b"), "th").join(texts.select(F.col("th").alias("hub"), F.col("text").alias("text_a")), "hub")
        found = sides.select("hub", "th", "text_a", "text_b").mapInPandas(lean(_compared(size, tenths)), "a long, b long")
        return saved(found, "similar")

    links = verified(met.where("th <> hub").select("hub", "th").distinct())
    tops = saved(components(links), "tops")
    top = met.join(tops, F.col("th") == F.col("node"), "left").select("bucket", "th", F.coalesce("component", "th").alias("top"))
    mixed = saved(top.groupBy("bucket").agg(F.min("top").alias("lo"), F.max("top").alias("hi")).where("lo < hi").select("bucket"), "mixed")
    open_texts = saved(met.join(small(mixed), "bucket", "left_semi").select("th").distinct(), "open")
    return links.union(verified(_prefix_pairs(texts.join(small(open_texts), "th", "left_semi"), tops, size, tenths)))
