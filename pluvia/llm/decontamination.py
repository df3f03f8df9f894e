"""Benchmark decontamination by spaced seeds: hashes that skip fixed word positions, checked around each hit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import lean, saved, small
from pluvia.llm.words import MARKS, word_hashes

#: 1: the word counts, 0: it may differ. At 70 % agreement a window of 24 words always has a place for one of these masks,
#: whichever words differ (tested over all choices). Five words each: shorter masks meet common phrases of a large benchmark.
MASKS = ("1101011", "110001011", "1001000111", "10100010011")
#: Items of 12 to 23 words need these as well (tested over all choices for each length).
MORE_MASKS = ("11111", "11000010011")
#: Items of fewer words are searched by their whole sequence.
SPAN = 12
#: Words of an item that are compared at once, the share of them that must agree, and the seeds of a benchmark that may go to each task.
WINDOW, SHARE, BITMAP_KEYS = 24, 0.7, 8_000_000
#: Hits of one alignment within this many words of an item are verified once.
BLOCK = 64
#: Hits that are expanded at a time, and alignments of a document that are verified together.
SLAB, TOGETHER = 1 << 18, 1_000


_FACTORS = np.random.default_rng(5).integers(1, 2**63, SPAN, dtype="uint64") * np.uint64(2) + np.uint64(1)
#: Bytes of the texts that are hashed together; small enough for a core's cache.
CHUNK_BYTES = 1 << 16


def _hash(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode(), MARKS, lower=True)[0]


def seeds(h: np.ndarray, masks: list[str]):
    """Yields (keys, span) by mask: for each position the sum of the words' hashes at the mask's places, each times the
    place's factor, plus a number of the mask. The words' hashes are well mixed, so the sum needs no more."""
    times: dict[int, np.ndarray] = {}
    for mask in masks:
        n = len(h) - len(mask) + 1
        keys = np.full(max(n, 0), zlib.crc32(mask.encode()) * 0xA24BAED4963EE407 % 2**64, dtype="uint64")
        for place, bit in enumerate(mask):
            if bit == "1" and n > 0:
                if place not in times:
                    times[place] = h * _FACTORS[place]
                keys += times[place][place : place + n]
        yield keys, len(mask)


def item_masks(words: int, window: int = WINDOW) -> list[str]:
    """The masks of an item: its whole sequence below the span, the first masks where windows are long enough, else all."""
    if words < SPAN:
        return ["1" * words] if words else []
    return [*MASKS, *(MORE_MASKS if min(words, window) < WINDOW else ())]


def _test_seeds(window: int):
    """Each distinct item: its words, and its seeds; items below the span by their whole word sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"], strict=True):
                h = _hash(text)
                for keys, _ in seeds(h, item_masks(len(h), window)):
                    yield pd.DataFrame({"key": keys.view("int64"), "item": item, "at": np.arange(len(keys), dtype="int32"), "words": len(h)})

    return run


def _chunks(ids: list, texts) -> Iterator[tuple[list, list[bytes]]]:
    held, size = ([], []), 0
    for i, text in zip(ids, texts, strict=True):
        data = (text or "").encode()
        held[0].append(i)
        held[1].append(data)
        size += len(data)
        if size >= CHUNK_BYTES:
            yield held
            held, size = ([], []), 0
    if held[0]:
        yield held


#: Bits of the filter that goes ahead of the join of large benchmarks: 8 MB, whatever the benchmark holds.
FILTER_BITS = 26


def _seed_filter(keys: DataFrame) -> np.ndarray:
    """2^FILTER_BITS bits, as 64-bit words: the upper bits of all seeds. Executors join them by bits; the driver gets the words."""
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    got = keys.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(bit).alias("b")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype="uint64")
    out[got["w"].to_numpy()] = got["b"].to_numpy().view("uint64")
    return out


def _train_seeds(masks: list[str], held: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ids, texts in _chunks(batch["th"].tolist(), batch["text"]):
                h, at, _ = word_hashes(b"\n".join(texts), MARKS, lower=True)
                begins = np.cumsum([0, *[len(x) + 1 for x in texts]])
                doc = np.searchsorted(begins, at, side="right") - 1
                first = np.searchsorted(at, begins)  # each document's first word
                for k, span in seeds(h, masks):
                    place = k >> np.uint64(64 - FILTER_BITS)
                    hit = np.flatnonzero(held[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                    hit = hit[doc[hit] == doc[hit + span - 1]]
                    out += [(key, ids[d], p) for key, d, p in zip(k[hit].view("int64").tolist(), doc[hit].tolist(), (hit - first[doc[hit]]).tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["key", "th", "pos"]).astype("int64")

    return run


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, window: int, share: float) -> bool:
    """Whether some `window` consecutive words of the item (all, if it has fewer) agree in at least `share` of the
    places with the document's words that lie `diagonal` further on."""
    i = np.arange(len(item))
    j = i + diagonal
    there = (j >= 0) & (j < len(doc))
    same = np.zeros(len(item), dtype="int64")
    same[there] = doc[j[there]] == item[there]
    n = min(window, len(item))
    sums = np.r_[0, np.cumsum(same)]
    return bool(len(item)) and bool(((sums[n:] - sums[:-n]) >= share * n - 1e-9).any())


class Benchmark:
    """The distinct items' words and their seeds, sorted, for searches within a task."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        self.items = np.array([i for i, _ in items], dtype="int64")
        words = [np.frombuffer(h, dtype="uint64") for _, h in items]
        self.words = np.concatenate([np.zeros(0, "uint64"), *words])
        self.size = np.array([len(w) for w in words], dtype="int64")
        self.first = np.cumsum(np.r_[0, self.size])
        self.masks = used_masks(np.unique(self.size), window)
        made = [(keys, first + np.arange(len(keys))) for w, first in zip(words, self.first, strict=False) for keys, _ in seeds(w, item_masks(len(w), window))]
        keys, place = (np.concatenate([np.zeros(0, t), *x]) for x, t in zip(zip(*made, strict=True) if made else ((), ()), ("uint64", "int64"), strict=True))
        order = np.argsort(keys, kind="stable")
        #: seeds and the place of their first word among all items' words
        self.keys, self.place = keys[order], place[order].astype("int32")
        digits = max(16, (16 * max(len(keys), 1)).bit_length())
        self.shift = np.uint64(64 - digits)
        self.bitmap = np.zeros(1 << digits, dtype=bool)
        self.bitmap[self.keys >> self.shift] = True

    def aligned(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct alignments that have a hit: the first word of a block of an item, and the place in h that it lies on,
        moved on by BLOCK for each document, so that a place before a document's first word isn't taken for the document before."""
        width, out = len(h) + BLOCK * (int(doc[-1]) + 2) if len(h) else 1, [np.zeros(0, "int64")]
        for k, span in seeds(h, self.masks):
            hit = np.flatnonzero(self.bitmap[k >> self.shift])
            hit = hit[doc[hit] == doc[hit + span - 1]]
            low = np.searchsorted(self.keys, k[hit], "left")
            times = np.searchsorted(self.keys, k[hit], "right") - low
            hit, low, times = hit[times > 0], low[times > 0], times[times > 0]
            cuts = np.flatnonzero(np.diff(np.cumsum(times) // SLAB)) + 1
            for p, e, n in zip(*(np.split(x, cuts) for x in (hit, low, times)), strict=True):
                begin = np.cumsum(n) - n
                place = self.place[np.repeat(e - begin, n) + np.arange(n.sum())].astype("int64")
                back = (place - self.first[np.searchsorted(self.first, place, "right") - 1]) % BLOCK
                out.append(np.unique((place - back) * width + np.repeat(p + BLOCK * (doc[p] + 1), n) - back))
        return np.divmod(np.unique(np.concatenate(out)), width)

    def found(self, h: np.ndarray, doc: np.ndarray, first: np.ndarray, window: int, share: float) -> set[tuple[int, int]]:
        """(document, item) of each verified overlap; h: the words of all documents, doc: whose they are, first: where they begin."""
        block, lies = self.aligned(h, doc)
        begins = first + BLOCK * np.arange(1, len(first) + 1)
        owner = np.searchsorted(begins - BLOCK, lies, "right") - 1
        item = np.searchsorted(self.first, block, "right") - 1
        at, shift = block - self.first[item], lies - begins[owner]
        out = set()
        for s in range(0, len(block), 4096):
            d, t, a = owner[s : s + 4096], item[s : s + 4096], at[s : s + 4096]
            ok = overlaps(h, first[d], first[d + 1], self.words, self.first[t], self.size[t], a, shift[s : s + 4096] - a, window, share)
            out |= set(zip(d[ok].tolist(), self.items[t[ok]].tolist(), strict=True))
        return out


def used_masks(sizes, window: int) -> list[str]:
    """The masks that items of these sizes have."""
    return list(dict.fromkeys(m for n in sizes for m in item_masks(int(n), window)))


def overlaps(h, begin, end, words, first, size, at, diagonal, window: int, share: float) -> np.ndarray:
    """For each alignment of a document (its words h[begin:end]) and an item (words[first:first + size]) whether some `window`
    consecutive words of the item (all, if it has fewer) that meet its block at `at` agree in at least `share` of the places."""
    low, high = np.maximum(0, at - window + 1), np.minimum(size, at + BLOCK + window - 1)
    length, n = high - low, np.minimum(window, size)
    of = np.repeat(np.arange(len(at)), length)
    off = np.arange(len(of)) - np.repeat(np.cumsum(length) - length, length)
    i = low[of] + off
    j = begin[of] + i + diagonal[of]
    there = (j >= begin[of]) & (j < end[of])
    same = there & (words[first[of] + i] == h[np.where(there, j, 0)])
    sums = np.r_[0, np.cumsum(same)]
    starts = np.flatnonzero(off + n[of] <= length[of])
    n = n[of[starts]]
    ok = np.zeros(len(at), dtype=bool)
    ok[of[starts[sums[starts + n] - sums[starts] >= share * n - 1e-9]]] = True
    return ok


def _searched(bench: Benchmark, window: int, share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ids, texts in _chunks(batch["th"].tolist(), batch["text"]):
                h, at, _ = word_hashes(b"\n".join(texts), MARKS, lower=True)
                begins = np.cumsum([0, *[len(x) + 1 for x in texts]])
                doc = np.searchsorted(begins, at, side="right") - 1
                out += [(ids[d], item) for d, item in bench.found(h, doc, np.searchsorted(at, begins), window, share)]
            yield pd.DataFrame(out, columns=["th", "item"]).astype("int64")

    return run


def _verified(window: int, share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, text, hits in zip(batch["th"].tolist(), batch["text"], batch["hits"], strict=True):
                doc, done = _hash(text), {}
                for hit in hits:
                    item = np.frombuffer(hit["h"], dtype="uint64")
                    done[hit["item"]] = done.get(hit["item"]) or overlap(doc, item, hit["diagonal"], window, share)
                out += [(row, item) for item, ok in done.items() if ok]
            yield pd.DataFrame(out, columns=["th", "item"]).astype("int64")

    return run


def _item_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"item": batch["item"], "h": [_hash(t).tobytes() for t in batch["text"]]})


def _joined(rows: DataFrame, distinct: DataFrame, words: DataFrame, window: int, share: float) -> DataFrame:
    """(th, item) of the verified overlaps, by a join of all seeds: for benchmarks too large for a task. Seeds of documents that
    no bit of a filter of fixed size stands for stay out of the shuffle."""
    keys = saved(distinct.mapInPandas(lean(_test_seeds(window)), "key long, item long, at int, words int"), "test-seeds")
    sizes = [r[0] for r in keys.select(F.least("words", F.lit(max(SPAN, window))).alias("n")).distinct().collect()]
    rows = rows.dropDuplicates(["th"])
    hits = rows.mapInPandas(lean(_train_seeds(used_masks(sorted(sizes), window), _seed_filter(keys))), "key long, th long, pos long")
    aligned = hits.join(small(keys), "key").select("th", "item", (F.col("pos") - F.col("at")).alias("diagonal")).distinct()
    aligned = saved(aligned, "aligned")
    lots = aligned.groupBy("th").agg(F.ceil(F.count("*") / TOGETHER).alias("lots"))
    dealt = aligned.join(small(saved(lots, "lots")), "th").withColumn("lot", F.expr("pmod(xxhash64(item, diagonal), lots)"))
    pairs = dealt.join(small(words), "item").groupBy("th", "lot").agg(F.collect_list(F.struct("item", "h", "diagonal")).alias("hits"))
    checked = rows.join(small(saved(pairs, "alignments")), "th").select("th", "text", "hits")
    return checked.mapInPandas(lean(_verified(window, share)), "th long, item long").distinct()


def _found(
    docs: DataFrame, benchmark: DataFrame, text_col: str, item_id: str, item_text: str, window: int, share: float, bitmap_keys: int
) -> DataFrame:
    """(th, item_ids): the items found in the texts with xxhash64 th, saved."""
    tests = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    named = saved(tests.withColumn("item", F.xxhash64("text")), "benchmark")
    distinct = named.groupBy("item").agg(F.first("text").alias("text"))
    rows = docs.select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).where("text is not null")
    words = saved(distinct.mapInPandas(_item_words, "item long, h binary"), "items")
    n = F.length("h") / 8
    long_masks, all_masks = (len(item_masks(m, window)) for m in (WINDOW, SPAN))
    made = F.when(n >= WINDOW, n * long_masks).when(n >= SPAN, n * all_masks).otherwise(F.least(n, F.lit(1)))
    if (words.agg(F.sum(made)).first()[0] or 0) <= bitmap_keys:
        bench = Benchmark([(r["item"], bytes(r["h"])) for r in words.collect()], window)
        found = rows.mapInPandas(lean(_searched(bench, window, share)), "th long, item long").distinct()
    else:
        found = _joined(rows, distinct, words, window, share)
    # an item without an id counts by its text, as null among the ids
    named = found.join(named.select("item", "item_id"), "item")
    ids = F.sort_array(F.collect_set(F.struct("item_id", F.when(F.col("item_id").isNull(), F.col("item")).alias("text"))))
    return saved(named.groupBy("th").agg(ids.getField("item_id").alias("item_ids")), "found")


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th): the contaminated rows of docs as their id and the xxhash64 of their text."""
    found = _found(docs, benchmark, text_col, "item_id", "text", WINDOW, SHARE, BITMAP_KEYS).select("th")
    return docs.select(F.col(id_col).alias(id_col), F.xxhash64(text_col).alias("th")).join(small(found), "th", "left_semi").select(id_col, "th")


def contaminated_documents(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, share: float = SHARE, bitmap_keys: int = BITMAP_KEYS,
) -> DataFrame:
    """One row per input row: id, contaminated, n_items, item_ids (benchmark items found in it, ascending).

    Words are runs of letters and digits in lower case. Every position of every document is hashed under each mask.
    A benchmark of at most `bitmap_keys` seeds goes to the tasks, which search their documents in place; a larger one is joined.
    Hits fix how item and document align. Each alignment is verified once, however many hits it has: the pair counts if, so aligned, `window`
    consecutive words of the item (all words of a shorter one) agree in at least `share` of the places. The masks hit
    every such overlap for a share of 0.7 or more and a window of 24.
    Items below 12 words are found by their whole sequence only. Equal items are searched once. Items with a null id count by
    their text; each is a null among item_ids, before the others.

    Null and empty texts, and items without words, are never contaminated or found. Rows are judged by their own texts, also
    where ids are null or repeat. Empty benchmark or documents: nothing found, no rows.
    """
    found = _found(docs, benchmark, text_col, item_id, item_text, window, share, bitmap_keys).withColumnRenamed("th", "t")
    none = F.array().cast("array<bigint>")
    out = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).join(small(found), F.col("h") == F.col("t"), "left")
    return out.select(
        F.col("id").alias(id_col), F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"),
    )
