"""Phrases that occur together: counts of padded windows of the longest length, summed to shorter prefixes.

Each word of a piece opens one window, which holds it and the words that lead it by one and two places; at the end of a
piece windows are padded. Only these windows are counted. A phrase of two words occurs as often as the windows that begin with
it, a word as often as the windows that it opens: Spark's ROLLUP makes these sums, so shorter n-grams are never listed.

Windows are counted within each task, then by window. Windows too rare to be a candidate are merged under the pad of the longest prefix
that may still matter, so ROLLUP reads little more than what is frequent. Windows are dealt by their first word; for words and pairs that
hold many windows (found in a sample of documents, which decides nothing but the dealing) by two or three words.

Counts are exact for languages of up to 10^15 words: products are made in decimals of 38 digits. Null texts count as
empty, null languages as `und`, rows are counted as often as they come, ids and other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import lean, running_total, saved, small

#: Words counted at once in a task, and bytes of text taken at once.
CHUNK_WORDS, CHUNK_BYTES = 1_000_000, 4_000_000
#: Text for each task that sums windows, and for the sample that finds words of many windows.
PARTITION_BYTES, SAMPLE_BYTES = 8_000_000, 8_000_000

#: 0 word, 1 between words, 2 end of a piece.
_KIND = np.zeros(256, dtype="uint8")
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
_GAP = pa.scalar(" ", pa.large_string())
WINDOWS = "key string, f long, place long"
PREFIXES = "lang string, w0 string, w1 string, w2 string, f long"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts in order, with the number of the text and of the piece of each."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype="int64")[texts.offset : texts.offset + len(texts) + 1]
    b = _LOWER[np.frombuffer(data, dtype="uint8")[offsets[0] : offsets[-1]]] if offsets[-1] > offsets[0] else np.zeros(0, dtype="uint8")
    offsets = offsets - offsets[0]
    kind = _KIND[b]
    inside = kind == 0
    begins = inside & ~np.r_[False, inside[:-1]]
    firsts = offsets[:-1][offsets[:-1] < len(b)]
    begins[firsts] = inside[firsts]  # a word doesn't run on into the next text
    starts = np.flatnonzero(begins)
    sizes = np.add.reduceat(inside, starts, dtype="int64") if len(starts) else np.zeros(0, dtype="int64")
    ends = np.r_[0, np.cumsum(sizes)].astype("int64")
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(b[inside].tobytes()))
    text = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.union1d(np.flatnonzero(kind == 2), firsts)
    return words, text, np.searchsorted(breaks, starts, side="right")


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The distinct rows of columns of codes below the given sizes, how often each comes, and for each row the place of its distinct row."""
    fits = np.prod([float(s) for s in sizes]) < 2.0**63
    if not fits:  # the first columns are numbered together
        (some, _, place), rest = _distinct(columns[:-1], sizes[:-1]), columns[-1]
        found, count, back = _distinct([place, rest], [len(some[0]), sizes[-1]])
        return [c[found[0]] for c in some] + [found[1]], count, back
    code = columns[0].astype("int64")
    for c, size in zip(columns[1:], sizes[1:], strict=True):
        code *= size
        code += c
    code, back, count = np.unique(code, return_inverse=True, return_counts=True)
    found = []
    for size in reversed(sizes[1:]):
        code, c = np.divmod(code, size)
        found.append(c)
    return [code, *reversed(found)], count, back


def _counted(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """As `_distinct`, without places: a plain sort does where the columns fit one number."""
    if np.prod([float(s) for s in sizes]) >= 2.0**63:
        return _distinct(columns, sizes)[:2]
    code = columns[0].astype("int64")
    for c, size in zip(columns[1:], sizes[1:], strict=True):
        code *= size
        code += c
    code.sort()
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    count = np.diff(np.r_[first, len(code)])
    code, found = code[first], []
    for size in reversed(sizes[1:]):
        code, c = np.divmod(code, size)
        found.append(c)
    return [code, *reversed(found)], count


def _fields(keys: pa.Array) -> list[pa.Array]:
    """The three words and the language of each key."""
    keys = keys.cast(pa.large_string())
    _, offsets, data = keys.buffers()
    offsets = np.frombuffer(offsets, dtype="int64")[keys.offset : keys.offset + len(keys) + 1]
    b = np.frombuffer(data, dtype="uint8")[offsets[0] : offsets[-1]]
    gaps = np.flatnonzero(b == 0x20)
    if len(gaps) != 3 * len(keys):  # a language with spaces
        cut = pc.split_pattern(keys, " ", max_splits=3).flatten()
        return [cut.take(pa.array(np.arange(k, len(cut), 4))) for k in range(4)]
    gaps, ends = gaps.reshape(-1, 3), offsets[1:] - offsets[0]
    starts = np.c_[offsets[:-1] - offsets[0], gaps + 1]
    ends = np.c_[gaps, ends]
    out = []
    for k in range(4):
        step = np.zeros(len(b) + 1, dtype="int8")
        step[starts[:, k]] += 1  # each start comes once, and so does each end
        step[ends[:, k]] -= 1
        held = b[np.cumsum(step[:-1], dtype="int8").view(bool)]
        out.append(pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(np.r_[0, np.cumsum(ends[:, k] - starts[:, k])].astype("int64")), pa.py_buffer(held.tobytes())))
    return out


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.asarray(words.to_numpy(zero_copy_only=False), dtype=object), categorize=False)


def _window_counter(hot: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts windows of (lang, text) batches: key is three words, empty where padded, and the language, joined by spaces."""

    def emit(parts: list) -> pa.RecordBatch:
        names = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        langs = pa.chunked_array([p[1] for p in parts]).combine_chunks().dictionary_encode()
        size, n_langs = len(names.dictionary) + 1, len(langs.dictionary)
        shift = np.cumsum([0, *(int(p[2][-1]) + 1 for p in parts[:-1])])
        piece = np.concatenate([p[2] + s for p, s in zip(parts, shift, strict=True)]).astype("int32")
        parts.clear()
        w0 = names.indices.to_numpy() + np.int32(1)
        leads = []
        for k in (1, 2):
            lead = np.zeros(len(w0), dtype="int32")
            if len(w0) > k:
                lead[:-k] = np.where(piece[k:] == piece[:-k], w0[k:], 0)
            leads.append(lead)
        (w0, w1, w2, lang), count = _counted([w0, *leads, langs.indices.to_numpy()], [size, size, size, n_langs])
        del piece, leads
        spelled = pa.concat_arrays([pa.array([""], pa.large_string()), names.dictionary])
        of = [spelled.take(pa.array(w)) for w in (w0, w1, w2)]
        key = pc.binary_join_element_wise(*of, langs.dictionary.take(pa.array(lang)), _GAP)
        # the words that decide where a window is counted
        h = np.r_[np.uint64(0), _hashes(names.dictionary)]
        place = h[w0]
        hot_words = np.r_[False, pc.is_in(names.dictionary, pa.array([x for x in hot if " " not in x], pa.large_string())).to_numpy(zero_copy_only=False)]
        busy = np.flatnonzero(hot_words[w0])
        if len(busy):
            place[busy] += h[w1[busy]] * np.uint64(0x9E3779B97F4A7C15)
            pairs = pc.binary_join_element_wise(of[0].take(pa.array(busy)), of[1].take(pa.array(busy)), _GAP)
            busy = busy[pc.is_in(pairs, pa.array([x for x in hot if " " in x], pa.large_string())).to_numpy(zero_copy_only=False)]
            place[busy] += h[w2[busy]] * np.uint64(0xC2B2AE3D27D4EB4F)
        return pa.RecordBatch.from_arrays([key.cast(pa.string()), pa.array(count.astype("int64")), pa.array(place.view("int64"))], ["key", "f", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype("int64"))
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK_BYTES)))
                piece = batch.slice(at, upto - at)
                at = upto
                words, text, pieces = _words(pc.fill_null(piece["text"], ""))
                if not len(words):
                    continue
                parts.append((words, piece["lang"].cast(pa.large_string()).take(pa.array(text)), pieces))
                held += len(words)
                if held >= CHUNK_WORDS:
                    yield emit(parts)
                    parts, held = [], 0
        if parts:
            yield emit(parts)

    return lean(run)


def _prefix_sums(least: int, hot: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums equal windows of a partition; rare ones go to the pad of the longest prefix that is frequent or counted elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting, rows = None, None, [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows > CHUNK_WORDS:  # equal windows of different tasks meet early, so that few wait
                keys, counts = summed(keys, counts, waiting)
                waiting, rows = [], 0
        if waiting or keys is not None:
            yield merged(*summed(keys, counts, waiting))

    def summed(keys, counts, waiting):
        held = [*([keys] if keys is not None else []), *(b["key"].cast(pa.large_string()) for b in waiting)]
        f = np.concatenate([*([counts] if counts is not None else []), *(b["f"].to_numpy() for b in waiting)])
        coded = pa.chunked_array(held).combine_chunks().dictionary_encode()
        return coded.dictionary, _sums(coded.indices.to_numpy(), f, len(coded.dictionary))

    def merged(keys: pa.Array, f: np.ndarray) -> pa.RecordBatch:
        w0, w1, w2, lang = (c.dictionary_encode() for c in _fields(keys))
        code = [c.indices.to_numpy().astype("int64") for c in (lang, w0, w1, w2)]
        sizes = [len(c.dictionary) for c in (lang, w0, w1, w2)]
        empty = [pc.equal(c.dictionary, "").to_numpy(zero_copy_only=False)[k] for c, k in ((w1, code[2]), (w2, code[3]))]
        words, _, word = _distinct(code[:2], sizes[:2])
        pairs, _, pair = _distinct([word, code[2]], [len(words[0]), sizes[2]])
        of_word, of_pair = _sums(word, f, len(words[0])), _sums(pair, f, len(pairs[0]))
        hot_words = pc.is_in(w0.dictionary, pa.array([x for x in hot if " " not in x], pa.large_string())).to_numpy(zero_copy_only=False)[code[1]]
        hot_pairs = np.zeros(len(f), dtype=bool)
        busy = np.flatnonzero(hot_words)
        if len(busy):
            spelled = pc.binary_join_element_wise(w0.dictionary.take(pa.array(code[1][busy])), w1.dictionary.take(pa.array(code[2][busy])), _GAP)
            hot_pairs[busy] = pc.is_in(spelled, pa.array([x for x in hot if " " in x], pa.large_string())).to_numpy(zero_copy_only=False)
        at_pair, at_word = (of_pair[pair] >= least) | hot_pairs, (of_word[word] >= least) | hot_words
        depth = np.where((f >= least) & ~empty[1], 3, np.where(at_pair & ~empty[0], 2, np.where(at_word, 1, 0)))
        # code 0 stands for the pad
        kept = [code[0], *(np.where(depth >= k, c + 1, 0) for k, c in enumerate(code[1:], 1))]
        found, _, back = _distinct(kept, [sizes[0], *(s + 1 for s in sizes[1:])])
        pad = pa.array([""], pa.large_string())
        spelled = [pa.concat_arrays([pad, c.dictionary]).take(pa.array(k)) for c, k in zip((w0, w1, w2), found[1:], strict=True)]
        columns = [lang.dictionary.take(pa.array(found[0])), *spelled]
        return pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in columns), pa.array(_sums(back, f, len(found[0])))], ["lang", "w0", "w1", "w2", "f"])

    return lean(run)


def _sums(place: np.ndarray, f: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(place, f, n).astype("int64")


def _hot_prefixes(docs: DataFrame, share: float, total: int) -> frozenset[str]:
    """Words and pairs that open more than `share` of the windows of a sample: at most 1/share of each."""
    part = docs.sample(min(1.0, SAMPLE_BYTES / max(total, 1)), seed=7)
    each = part.mapInArrow(_window_counter(frozenset()), WINDOWS)
    cut = F.split("key", " ", 4)
    sums = each.select(cut[0].alias("w0"), cut[1].alias("w1"), "f").rollup("w0", "w1").agg(F.sum("f").alias("f"), F.grouping_id().alias("left_out"))
    sums = saved(sums, "sampled")
    n = sums.where("left_out = 3").first()
    if n is None or not n["f"]:
        return frozenset()
    found = sums.where((F.col("left_out") < 2) & (F.col("f") > share * n["f"])).select(F.concat_ws(" ", "w0", "w1").alias("p")).collect()
    return frozenset(r["p"] for r in found)


def phrase_counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, words, phrase, f) of every phrase of one to three words that occurs `least` times; words 0 has the sum of each language."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PARTITION_BYTES)
    hot = _hot_prefixes(docs, 0.1 / parts, total)
    counted = docs.mapInArrow(_window_counter(hot), WINDOWS).repartition(parts, "place")
    sums = counted.mapInArrow(_prefix_sums(least, hot), PREFIXES)
    rolled = sums.rollup("lang", "w0", "w1", "w2").agg(F.sum("f").alias("f"), F.grouping_id().alias("left_out")).where("left_out < 15")
    words = F.when(F.col("left_out") == 0, 3).when(F.col("left_out") == 1, 2).when(F.col("left_out") == 3, 1).otherwise(0)
    longest = F.when(F.col("left_out") == 0, F.col("w2")).when(F.col("left_out") == 1, F.col("w1")).when(F.col("left_out") == 3, F.col("w0")).otherwise(F.lit("-"))
    return rolled.where((longest != "") & ((F.col("f") >= least) | (F.col("left_out") == 7))).select("lang", words.alias("words"), F.concat_ws(" ", "w0", "w1", "w2").alias("phrase"), "f")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside: int = 50, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of two and three words of each language.

    a is the phrase's count, l and r those of its parts at the cut of the lowest score (ties: the first cut), n the language's words and
    score = floor(1000000 a a / (l r)). Phrases within a longer one that occurs in at least `inside` per cent of their
    places are left out. Ranks follow score and a, both falling, then the phrase in byte order.
    """
    counts = saved(phrase_counts(docs, least, text, lang), "phrases")
    known = counts.where("words > 0").select("lang", "phrase", "f")
    found = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    # each candidate asks for the counts of its parts, cut after its first and, if it has three words, its second word
    one = F.substring_index("phrase", " ", 1)
    last = F.substring_index("phrase", " ", -1)
    behind = F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    cuts = F.when(F.col("words") == 2, F.array(cut(1, one, last))).otherwise(F.array(cut(1, one, behind), cut(2, F.substring_index("phrase", " ", 2), last)))
    asked = saved(found.select("lang", "words", "phrase", "a", F.inline(cuts)), "cuts")
    left, right = (small(known.withColumnsRenamed({"phrase": side, "f": side[0]})) for side in ("left", "right"))
    scored = saved(asked.join(left, ["lang", "left"]), "left-parts").join(right, ["lang", "right"])
    score = F.expr("1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = scored.withColumn("score", score).groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # the most frequent longer phrase around each pair
    around = found.where("words = 3").select("lang", F.col("a").alias("longer"), F.explode(F.array(F.substring_index("phrase", " ", 2), behind)).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    best = saved(best, "scored").join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("words") == 3) | (100 * F.col("longer") < inside * F.col("a")))
    rows = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score", (-F.col("best.score")).alias("_s"), (-F.col("a")).alias("_a"), F.lit(1).alias("_one"))
    # ranks are places in one order of all languages, less the rows of the languages before
    placed = saved(running_total(rows, ["lang", "_s", "_a", "phrase"], "_one", "_place"), "placed")
    first = placed.groupBy("lang").agg(F.min("_place").alias("_first"))
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    langs = small(saved(first.join(sizes, "lang"), "langs"))
    rank = (F.col("_place") - F.col("_first") + 1).cast("long").alias("rank")
    return placed.join(langs, "lang").select("lang", rank, "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)
