"""Removal of passages that an earlier document has too, by repeated-phrase automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean, saved, small
from pluvia.llm.words import mix, powers, spaced, word_hashes

#: Words of an anchor phrase. Of the phrases in a window, the one with the smallest hash is its anchor, so equal windows
#: have equal anchors, and neighbouring windows mostly share one.
PHRASE = 8
_ODD, _INVERSE = np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def anchors(h: np.ndarray, window: int) -> np.ndarray:
    """The anchor hash of each window of words with hashes h."""
    phrase = min(PHRASE, window)
    x, width = spaced(h, tuple(range(phrase)), 1), window - phrase + 1
    if len(x) < width:
        return np.zeros(0, dtype="uint64")
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def window_hashes(h: np.ndarray, window: int) -> np.ndarray:
    if len(h) < window:
        return np.zeros(0, dtype="uint64")
    sums = np.r_[np.uint64(0), np.cumsum(h * powers(_ODD, len(h)), dtype="uint64")]
    return mix((sums[window:] - sums[:-window]) * powers(_INVERSE, len(h) + 1)[: len(sums) - window])


def _hashes(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode())[0]


def _anchored(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(anchors(_hashes(text), window)) for text in batch["text"]]
            n = [len(a) for a in found]
            if sum(n):
                yield pd.DataFrame({"anchor": np.concatenate(found).view("int64"), "id": np.repeat(batch["id"].to_numpy(), n), "th": np.repeat(batch["th"].to_numpy(), n)})

    return run


def _candidates(window: int, rows: int = 200_000):
    """Windows with a recurring anchor: hash, id, and place (31 bits of the text's hash, then the word's number)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, size = [], 0
            for i, th, text, known in zip(batch["id"].tolist(), batch["th"].tolist(), batch["text"], batch["anchors"], strict=True):
                h = _hashes(text)
                at = np.flatnonzero(np.isin(anchors(h, window), np.asarray(known, dtype="int64").view("uint64")))
                held.append((window_hashes(h, window)[at].view("int64"), np.full(len(at), i), at | ((th & 0x7FFFFFFF) << 32)))
                size += len(at)
                if size >= rows:
                    yield _windows(held)
                    held, size = [], 0
            yield _windows(held)

    return run


def _windows(held: list) -> pd.DataFrame:
    columns = [np.concatenate(c) if held else np.zeros(0, "int64") for c in (zip(*held, strict=True) if held else ((), (), ()))]
    return pd.DataFrame(dict(zip(("w", "id", "pos"), columns, strict=True)))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (id, pos) to runs in which place and source place go on together; a run may end with a batch."""
    for batch in batches:
        if not len(batch):
            continue
        step = np.diff(batch[["id", "pos", "src", "src_pos"]].to_numpy(), axis=0)
        start = np.flatnonzero(np.r_[True, (step != [0, 1, 0, 1]).any(axis=1)])
        out = batch.iloc[start].reset_index(drop=True)
        out["n"] = np.diff(np.r_[start, len(batch)])
        yield out


def _passages(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, text, cuts in zip(batch["id"], batch["text"], batch["cuts"], strict=True):
                words = (text or "").encode().split()
                for cut in cuts:
                    at = int(cut["src_pos"]) & 0xFFFFFFFF
                    out.append((i, cut["src_pos"], cut["n"], b" ".join(words[at : at + cut["n"] + window - 1])))
            yield pd.DataFrame(out, columns=["src", "src_pos", "n", "passage"])

    return run


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _cleaned(window: int):
    """Compiles the shard's passages to one automaton over word numbers and streams the shard's documents through."""

    def run(key, docs: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        first: dict[tuple, int] = {}
        for src, passage in zip(passages["src"].tolist(), passages["passage"], strict=True):
            ids = tuple(number.setdefault(w, len(number) + 1) for w in passage.split(b" "))
            first[ids] = min(src, first.get(ids, src))
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, src in first.items():
            automaton.add_word(ids, (len(ids), src))
        if first:
            automaton.make_automaton()
        out = []
        for i, text in zip(docs["id"].tolist(), docs["text"], strict=True):
            words = (text or "").encode().split()
            edge = np.zeros(len(words) + 1, dtype="int64")
            if first:
                for end, (n, src) in automaton.iter(tuple(number.get(w, 0) for w in words)):
                    if src < i:
                        edge[end - n + 1] += 1
                        edge[end + 1] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            out.append((i, len(words), int(gone.sum()), _digest([w for w, g in zip(words, gone.tolist(), strict=True) if not g])))
        return pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_sha256"])

    return run


def _untouched(window: int):
    """Documents that share nothing, and copies of an earlier text, which go as a whole if a window fits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, none, text, copy in zip(batch["id"].tolist(), batch["id_none"].tolist(), batch["text"], batch["copy"].tolist(), strict=True):
                words = (text or "").encode().split()
                gone = len(words) if copy and len(words) >= window else 0
                out.append((i, none, len(words), gone, _digest([] if gone else words)))
            yield pd.DataFrame(out, columns=["id", "id_none", "n_words", "n_removed", "kept_sha256"])

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, shard_bytes: int = 4 << 20
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space).

    Words are runs of anything but ASCII white space. A word goes if a window of `window` words that covers it
    also starts in a document with a smaller id, as the documents came in. Steps:

    1. Each window names its anchor phrase; anchors that two different texts share are kept.
    2. Windows with such an anchor are hashed; a hash with a smallest id below others is a confirmed repeat.
    3. Runs of confirmed windows give passages, read from their first document.
    4. Documents with repeats are dealt to shards. Each shard compiles its passages to an Aho-Corasick automaton and
       streams its documents through it; every occurrence of a passage from a smaller id is removed.

    What a shard holds follows the documents dealt to it (about `shard_bytes` of texts), not the corpus. Exact copies of a text
    need no windows: all but the smallest id go as a whole. Null text: no words. Fewer words than a window: kept.
    Rows with a null id are kept whole and are no source. Rows with equal ids never remove from each other.
    Empty input: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    sure = rows.where("id is not null and text is not null")

    met = saved(sure.mapInPandas(lean(_anchored(window)), "anchor long, id long, th long"), "anchors")
    shared = met.groupBy("anchor").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo < hi").select("anchor")
    # saved, so that the join stands on plain exchanges and an anchor that very many documents share can be split
    shared = saved(shared, "shared")
    mine = met.join(shared, "anchor").groupBy("id", "th").agg(F.collect_list("anchor").alias("anchors"))
    windows = sure.join(mine, ["id", "th"]).mapInPandas(lean(_candidates(window)), "w long, id long, pos long")
    windows = saved(windows, "windows")
    firsts = windows.groupBy("w").agg(F.min(F.struct("id", "pos")).alias("lo"), F.max("id").alias("hi")).where("lo.id < hi")
    # saved, so that the join stands on plain exchanges and a window that very many documents share can be split
    firsts = saved(firsts.select("w", F.col("lo.id").alias("src"), F.col("lo.pos").alias("src_pos")), "firsts")
    later = windows.join(firsts, "w").where("id > src")
    ordered = later.select("id", "pos", "src", "src_pos").repartition("id").sortWithinPartitions("id", "pos")
    runs = saved(ordered.mapInPandas(lean(_runs), "id long, pos long, src long, src_pos long, n long"), "runs")

    texts = sure.select("id", "th", F.sha2("text", 256).alias("sha"))
    least = saved(texts.groupBy("sha").agg(F.min("id").alias("least")), "least")
    copies = texts.join(least, "sha").where("id > least").select("id", "th").distinct().withColumn("copy", F.lit(True))
    row = F.col("pos").bitwiseAND(F.lit(0x7FFFFFFF << 32))
    short = F.shiftleft(F.col("th").bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    copies = saved(copies.withColumn("row", short).drop("th"), "copies")
    touched = runs.select("id", row.alias("row")).distinct().join(copies, ["id", "row"], "left_anti")
    state = saved(copies.unionByName(touched.withColumn("copy", F.lit(False))), "state")
    known = small(state.withColumnRenamed("id", "i"))
    marked = rows.join(known, (F.col("id") == F.col("i")) & (short == F.col("row")), "left")
    schema = "id long, n_words long, n_removed long, kept_sha256 string"
    plain = marked.where("copy is null or copy").select("id", "text", F.coalesce("copy", F.lit(False)).alias("copy"))
    plain = ids_from_python(ids_for_python(plain).mapInPandas(lean(_untouched(window)), schema.replace("id long", "id long, id_none boolean")))

    changed = state.where(~F.col("copy")).select("id", "row")
    total = marked.where(~F.col("copy")).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    live = runs.withColumn("row", row).join(changed, ["id", "row"], "left_semi")
    needs = saved(live.select(shard.alias("shard"), "src", "src_pos", "n").distinct(), "needs")
    cuts = needs.select("src", "src_pos", "n").distinct().groupBy("src", F.col("src_pos").bitwiseAND(F.lit(0x7FFFFFFF << 32)).alias("row"))
    cuts = small(saved(cuts.agg(F.collect_list(F.struct("src_pos", "n")).alias("cuts")), "cuts"))
    sources = sure.join(cuts, (F.col("id") == F.col("src")) & (short == F.col("row"))).select("id", "text", "cuts")
    passages = sources.mapInPandas(lean(_passages(window)), "src long, src_pos long, n long, passage binary")
    dealt = needs.join(passages, ["src", "src_pos", "n"]).select("shard", "src", "passage")
    due = marked.where(~F.col("copy")).select(shard.alias("shard"), "id", "text")
    cleaned = due.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(_cleaned(window), schema)
    return plain.unionByName(cleaned).withColumnRenamed("id", id_col)
