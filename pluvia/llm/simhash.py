"""SimHash fingerprints of texts and exact near-duplicate groups by sharded vantage-point trees."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean, saved, small
from pluvia.llm.graph import components, forest


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """64-bit SimHash of a whole text: majority of the bits of XXH64 over its word shingles, 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only 20 and 09-0D separate
    n = len(words)
    if not n:
        return 0
    hashed = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if n <= shingle:
        return hashed(joined, seed)
    lengths = np.fromiter(map(len, words), "int64", n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    h = np.array([hashed(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)], dtype="<u8")
    ones = np.zeros(64, dtype="int64")
    for at in range(0, len(h), 65536):
        part = h[at : at + 65536].view("uint8").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], dtype="uint64")
            yield batch[["id", "id_none", "th"]].assign(fp=fp.view("int64"))

    return run


def fingerprint_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One saved row per input row: id, th (xxhash64 of the text, which tells rows with one id apart), fp (64 bits as a long)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    marked = ids_for_python(rows).mapInPandas(lean(_fingerprints(shingle, seed)), "id long, id_none boolean, th long, fp long")
    return saved(ids_from_python(marked), "fingerprints")


# A tree compares one block of bits. Blocks (mask, radius) with the sum of (radius + 1) above the distance
# sought miss no pair: a pair within the distance is within the radius of at least one block.
def blocks_for(distance: int, blocks: int = 2) -> list[tuple[int, int]]:
    """`blocks` (at most distance + 1) runs of bits with their radii. More blocks: narrower searches, more rows."""
    blocks = min(blocks, distance + 1)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    left = distance + 1 - blocks  # one more for some blocks, until the sum is reached
    return [((1 << high) - (1 << low), left // blocks + (k < left % blocks)) for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False))]


def _far(fp: np.ndarray, point: int, mask: int) -> np.ndarray:
    return np.bitwise_count((fp ^ np.uint64(point)) & np.uint64(mask)).astype("int16")


def plant(sample: np.ndarray, mask: int, depth: int, rng) -> tuple | None:
    """Vantage-point tree over a sample, `depth` levels: (point, median distance, inner, outer), None as a leaf."""
    if depth == 0 or len(sample) < 4:
        return None
    point = int(rng.choice(sample))
    d = _far(sample, point, mask)
    mid = int(np.median(d))
    mid -= bool((d <= mid).all())
    if not (d <= mid).any():
        return None
    return point, mid, plant(sample[d <= mid], mask, depth - 1, rng), plant(sample[d > mid], mask, depth - 1, rng)


def route(fp: np.ndarray, tree: tuple | None, mask: int, radius: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, rows to query there, which of them live there). A row lives in one shard and queries each shard
    that the triangle bound |d(row, point) - median| <= radius does not rule out."""
    out, todo = [], [(tree, 1, np.arange(len(fp)), np.ones(len(fp), dtype=bool))]
    while todo:
        node, shard, rows, live = todo.pop()
        if not len(rows):
            continue
        if node is None:
            out.append((shard, rows, live))
            continue
        point, mid, inner, outer = node
        d = _far(fp[rows], point, mask)
        go = d <= mid + radius
        todo.append((inner, 2 * shard, rows[go], live[go] & (d[go] <= mid)))
        go = d > mid - radius
        todo.append((outer, 2 * shard + 1, rows[go], live[go] & (d[go] > mid)))
    return out


def search(members: np.ndarray, queries: np.ndarray, mask: int, radius: int, distance: int, leaf: int = 192) -> tuple:
    """Index pairs (member, query) of all fingerprints within `distance`, by a vantage-point tree over the members.

    Branches are pruned by the triangle bound on the block `mask`; once the block can't tell members apart
    any more, on all 64 bits.
    """
    full, found = (1 << 64) - 1, []
    todo = [(np.arange(len(members)), np.arange(len(queries)), mask, radius)]
    while todo:
        m, q, bits, r = todo.pop()
        if not len(m) or not len(q):
            continue
        split = False
        if len(m) > leaf:
            point = int(members[m[len(m) // 2]])
            dm = _far(members[m], point, bits)
            mid = int(np.median(dm))
            mid -= bool((dm <= mid).all())
            split = bool((dm <= mid).any())
            if not split and bits != full:
                todo.append((m, q, full, distance))
                continue
        if split:
            dq = _far(queries[q], point, bits)
            todo.append((m[dm <= mid], q[dq <= mid + r], bits, r))
            todo.append((m[dm > mid], q[dq > mid - r], bits, r))
            continue
        for at in range(0, len(q), 4096):
            part = q[at : at + 4096]
            near = np.bitwise_count(members[m][None, :] ^ queries[part][:, None]) <= distance
            i, j = np.nonzero(near)
            found.append((m[j], part[i]))
    if not found:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _rooted(trees: list):
    """Rows (tree, shard, fp, live) by the trees' upper levels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy().view("uint64")
            for t, (mask, radius, tree) in enumerate(trees):
                for shard, rows, live in route(fp, tree, mask, radius):
                    yield pd.DataFrame({"tree": np.int32(t), "shard": np.int64(shard), "fp": fp[rows].view("int64"), "live": live, "stuck": False})

    return run


def _planted(blocks: list, depth: int, seed: int):
    """The lower levels of one shard's tree, from a sample of its members."""

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        fp = np.sort(group["fp"].to_numpy()).view("uint64")
        tree = plant(fp, blocks[key[0]][0], depth, np.random.default_rng([seed, key[1] & 0x7FFFFFFF]))
        return pd.DataFrame({"tree": [key[0]], "shard": [key[1]], "below": [pickle.dumps(tree)]})

    return run


def _deeper(blocks: list):
    """Rows of shards that have lower levels, routed on; a shard that can't be split is marked as stuck."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (t, shard), part in batch.groupby(["tree", "shard"], sort=False):
                fp, tree, live = part["fp"].to_numpy().view("uint64"), pickle.loads(part["below"].iloc[0]), part["live"].to_numpy()
                mask, radius = blocks[t]
                for below, rows, own in route(fp, tree, mask, radius):
                    levels = below.bit_length() - 1
                    at = (shard << levels) | (below - (1 << levels))
                    yield pd.DataFrame({"tree": np.int32(t), "shard": np.int64(at), "fp": fp[rows].view("int64"), "live": own & live[rows], "stuck": tree is None})

    return run


def _linked(blocks: list, distance: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        mask, radius = blocks[key[0]]
        member = group["member"].to_numpy()
        fp = group["fp"].to_numpy()
        own, asked = fp[member], fp[~member]
        i, j = search(own.view("uint64"), asked.view("uint64"), mask, radius, distance)
        a, b = own[i], asked[j]
        keep = a != b
        roots = forest(zip(a[keep].tolist(), b[keep].tolist(), strict=True))
        return pd.DataFrame([(x, r) for x, r in roots.items() if x != r], columns=["a", "b"]).astype("int64")

    return run


_DEALT = "tree int, shard long, fp long, live boolean, stuck boolean"


def dealt_to_shards(prints: DataFrame, blocks: list, shard_rows: int, sample_rows: int, seed: int) -> DataFrame:
    """(tree, shard, fp, live) of the distinct fingerprints `fp`: where each lives and, with it, which shards it queries.

    The upper levels are fitted on at most `sample_rows` fingerprints on the driver. Shards that are still large then grow lower
    levels of their own, each from a sample of its members in a task of its own, until all are within four times `shard_rows` or can't be split.
    """
    total = prints.count()
    depth = min(max(0, int(np.ceil(np.log2(max(total, 1) / shard_rows)))), max(0, int(np.log2(sample_rows / 16))))
    chosen = prints.orderBy(F.xxhash64("fp"), "fp").limit(min(sample_rows, 32 << depth)).collect() if depth else []
    sample, rng = np.array([r["fp"] for r in chosen], dtype="int64").view("uint64"), np.random.default_rng(seed)
    trees = [(mask, radius, plant(sample, mask, depth, rng)) for mask, radius in blocks]
    dealt = saved(prints.mapInPandas(lean(_rooted(trees)), _DEALT), "shards")
    for turn in range(50):
        sums = dealt.where("live and not stuck").groupBy("tree", "shard").count().where(F.col("count") > 4 * shard_rows)
        large = saved(sums, "large")
        if large.isEmpty():
            break
        # about 512 members of each large shard by hash; five levels keep 16 of them in a leaf
        place = F.pmod(F.xxhash64("fp", F.lit(turn)), F.col("count")) < 512
        below = dealt.where("live and not stuck").join(small(large), ["tree", "shard"]).where(place)
        below = saved(below.groupBy("tree", "shard").applyInPandas(_planted(blocks, 5, seed), "tree int, shard long, below binary"), "trees")
        moved = dealt.where("not stuck").join(small(below), ["tree", "shard"]).mapInPandas(lean(_deeper(blocks)), _DEALT)
        still = dealt.where("not stuck").join(small(below.drop("below")), ["tree", "shard"], "left_anti").select(*dealt.columns)
        dealt = saved(moved.unionByName(still).unionByName(dealt.where("stuck")), "shards")
    return dealt.drop("stuck")


def linked_fingerprints(
    marked: DataFrame, distance: int = 3, seed: int = 42, shard_rows: int = 8192, sample_rows: int = 32768, blocks: int = 2
) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` within `distance` bits, of which each shard keeps a spanning forest."""
    by = blocks_for(distance, blocks)
    prints = saved(marked.select("fp").distinct(), "classes")
    dealt = dealt_to_shards(prints, by, shard_rows, sample_rows, seed)
    # shards above four times shard_rows members, or with very many queries, are cut into parts
    parts = lambda n, most: F.ceil(F.greatest(n, F.lit(1)) / most).cast("int")
    sums = dealt.groupBy("tree", "shard").agg(parts(F.count_if("live"), 4 * shard_rows).alias("ms"), parts(F.count("*"), 16 * shard_rows).alias("qs"))
    sums = saved(sums, "parts")
    rows = dealt.join(small(sums), ["tree", "shard"]).withColumn("x", F.xxhash64("fp", F.lit(7)))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod("x", F.col(n)).cast("int")
    asked = rows.select("tree", "shard", upto("ms").alias("mpart"), own("qs").alias("qpart"), F.lit(False).alias("member"), "fp")
    held = rows.where("live").select("tree", "shard", own("ms").alias("mpart"), upto("qs").alias("qpart"), F.lit(True).alias("member"), "fp")
    edges = asked.unionByName(held).groupBy("tree", "shard", "mpart", "qpart").applyInPandas(_linked(by, distance), "a long, b long")
    # saved, so that no task holds the search's worker and the next step's at once
    return saved(edges, "links")


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, seed: int = 42, **how
) -> DataFrame:
    """One row per input row: id, fingerprint (16 lowercase hex digits), component_id (smallest id reachable).

    Equal fingerprints are one class. Distinct fingerprints are dealt out to shards by vantage-point trees,
    each over the Hamming distance on one block of the bits: a pair within `distance` bits is close in one
    block, so nothing is missed. Each fingerprint lives in one shard of a tree and queries every shard that
    the triangle bound leaves open; within a shard an inner tree prunes again and the leaves compare all 64 bits.
    The trees are fitted on samples; that decides balance, not results. Their depth follows the number of fingerprints.

    Null or empty text: fingerprint zero, linked like any other. Fewer words than a shingle: the whole sequence is
    hashed. Repeated rows are all returned, and rows with one id but different texts are linked by their texts only. Null ids keep
    their row; they name no component: it is null where no other id is reachable. Empty input: no rows.
    """
    marked = fingerprint_rows(docs, id_col, text_col, shingle, seed)
    roots = saved(components(linked_fingerprints(marked, distance, seed, **how)), "roots")
    classes = marked.groupBy("fp").agg(F.min("id").alias("least")).join(roots, F.col("fp") == F.col("node"), "left")
    classes = saved(classes.select("fp", "least", F.coalesce("component", "fp").alias("root")), "classes")
    tops = saved(classes.groupBy("root").agg(F.min("least").alias("top")), "tops")
    tops = saved(classes.join(tops, "root").select("fp", "top"), "tops")
    return marked.join(tops, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("top").alias("component_id")
    )
