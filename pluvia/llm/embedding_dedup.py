"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean, saved, small
from pluvia.llm.graph import components, forest


def _classes(kind: str):
    """Row id, label, digest of (label, components) and the components as bytes; null where nothing can link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, none, label, v in zip(batch["id"].tolist(), batch["id_none"].tolist(), batch["label"], batch["v"], strict=True):
                x = None if v is None else np.array([np.nan if c is None else c for c in v], dtype=kind)
                ok = x is not None and x.size and label is not None and np.isfinite(x).all() and x.any()
                data = (x + x.dtype.type(0)).tobytes() if ok else None
                digest = hashlib.sha1(f"{label}|".encode() + data).digest() if ok else None
                rows.append((i, none, label, digest, data))
            yield pd.DataFrame(rows, columns=["id", "id_none", "label", "digest", "data"])

    return run


def _unit(data, kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(d, dtype=kind) for d in data]).astype("float64")
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def meeting(distance: float, width: float) -> float:
    """Probability that two vectors at a distance fall into one step of a projection."""
    c = width / distance
    return math.erf(c / math.sqrt(2)) - math.sqrt(2 / math.pi) / c * (1 - math.exp(-c * c / 2))


def plan(classes: int, threshold: float, width: float = 1.5, miss: float = 1e-3) -> tuple[int, int, float]:
    """(tables, projections, width) for the largest group of vectors that are compared with each other: as many projections as leave n^-0.1 unlike
    vectors in a bucket (steps are widened until it is that), and tables so that a pair at the threshold meets in none with probability `miss` at most."""
    unlike, n = math.sqrt(2), max(classes, 1) ** 1.1
    projections = max(6, math.ceil(math.log(n) / -math.log(meeting(unlike, width))))
    while meeting(unlike, width * 1.005) ** projections * n <= 1 and width < 2:
        width *= 1.005
    near = meeting(math.sqrt(2 - 2 * threshold), width)
    return math.ceil(math.log(miss) / math.log1p(-(near**projections))), projections, width


def signatures(unit: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """int64 [rows, tables]: in each table, a mix of the quantised projections floor((a.v + b) / width)."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    a = rng.standard_normal((unit.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    steps = np.floor((unit @ a + b) / width).astype("int64").view("uint64").reshape(len(unit), tables, projections)
    odd = rng.integers(1, 2**63, projections, dtype="uint64") | np.uint64(1)
    mixed = (steps * odd).sum(axis=2, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))).view("int64")


def _buckets(how: tuple, kind: str):
    """(node, slot, bucket) without the vector: the bucket of each class in each table, told apart by label and length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["data"].map(len)):
                sig = signatures(_unit(part["data"], kind), *how)
                salt = part["label"].map(lambda x: int.from_bytes(hashlib.sha1(f"{x}|{sig.shape}".encode()).digest()[:8], "little", signed=True)).to_numpy()
                tables = sig.shape[1]
                yield pd.DataFrame({
                    "node": np.repeat(part["node"].to_numpy(), tables), "slot": np.tile(np.arange(tables, dtype="int32"), len(part)),
                    "bucket": (sig ^ salt[:, None]).reshape(-1),
                })

    return run


def _compare(chunk: pd.DataFrame, threshold: float, how: tuple, kind: str) -> pd.DataFrame:
    parts = [_links(part.reset_index(drop=True), threshold, how, kind) for _, part in chunk.groupby("dim", sort=False)]
    return pd.concat(parts, ignore_index=True)


def _links(chunk: pd.DataFrame, threshold: float, how: tuple, kind: str, small_group: int = 128) -> pd.DataFrame:
    """Links within the groups of a chunk sorted by group: rows of (node, links), and a spanning forest (a, b)."""
    links, edges = np.zeros(len(chunk), dtype="int64"), []
    size, node, slot = chunk["size"].to_numpy(), chunk["node"].to_numpy(), chunk["slot"].to_numpy()
    block, apart = chunk["block"].to_numpy(), (chunk["p"] != chunk["q"]).to_numpy()
    unit = _unit(chunk["data"], kind)
    new = np.ones(len(chunk), dtype=bool)
    for c in _GROUP:
        x = chunk[c].to_numpy()
        new[1:] &= x[1:] == x[:-1]
    starts = np.flatnonzero(np.r_[True, ~new[1:]])
    ends = np.repeat(np.r_[starts[1:], len(chunk)], np.diff(np.r_[starts, len(chunk)]))

    def count(i: np.ndarray, j: np.ndarray) -> None:
        keep = ~(apart[i] & (block[i] == block[j]))
        i, j = i[keep], j[keep]
        if len(i):
            both, where = np.unique(np.r_[i, j], return_inverse=True)
            sig = signatures(unit[both], *how)
            x, y = sig[where[: len(i)]], sig[where[len(i) :]]
            first = np.argmax(x == y, axis=1) >= slot[i]  # the first table in which a pair meets counts it
            i, j = i[first], j[first]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            roots = forest(zip(node[i].tolist(), node[j].tolist(), strict=True))
            edges.extend((a, b) for a, b in roots.items() if a != b)

    begun = np.repeat(starts, np.diff(np.r_[starts, len(chunk)]))
    rows = np.flatnonzero(ends - begun <= small_group)
    for k in range(1, small_group):
        rows = rows[rows + k < ends[rows]]
        if not len(rows):
            break
        near = np.einsum("ij,ij->i", unit[rows], unit[rows + k]) >= threshold
        count(rows[near], rows[near] + k)
    for s in starts[np.r_[starts[1:], len(chunk)] - starts > small_group].tolist():
        e = int(ends[s])
        for at in range(s, e, 512):
            i, j = np.nonzero(unit[at : min(at + 512, e)] @ unit[s:e].T >= threshold - 1e-9)
            i, j = i + at, j + s
            i, j = i[i < j], j[i < j]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            count(i[near], j[near])
    some, none = np.flatnonzero(links), [None] * len(edges)
    whole = lambda values: pd.array(values, dtype="Int64")
    return pd.DataFrame({
        "node": whole([*node[some].tolist(), *none]), "links": whole([*links[some].tolist(), *none]),
        "a": whole([*[None] * len(some), *(a for a, _ in edges)]), "b": whole([*[None] * len(some), *(b for _, b in edges)]),
    })


_GROUP = ["bucket", "slot", "p", "q", "label", "dim"]


def _pairs(threshold: float, how: tuple, kind: str):
    """Compares the rows of each group; groups come one after another and may span batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            chunk = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(chunk):
                continue
            last = np.ones(len(chunk), dtype=bool)
            for c in _GROUP:
                last &= (chunk[c] == chunk[c].iloc[-1]).to_numpy()
            cut = int(np.argmax(last))
            if cut:
                yield _compare(chunk.iloc[:cut].reset_index(drop=True), threshold, how, kind)
            rest = chunk.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield _compare(rest, threshold, how, kind)

    return run


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93,
    seed: int = 7, block_rows: int = 2048,
) -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly), component_id (smallest id reachable), kept.

    Two vectors link if their labels are equal and not null and their cosine in double precision is at least
    `threshold`. Equal vectors are one class and are counted, not paired. Each class falls into one bucket of
    each hash table; every pair of classes in a bucket is compared. Projections grow with the logarithm of the largest label's classes and
    the tables with them (`plan`), so the work grows as the rows to the power 1.25 and not 2; a pair at the threshold meets in some
    table with probability 0.999, a closer pair more often.
    Buckets above `block_rows` rows are compared as pairs of blocks in tasks of their own.

    Only buckets of two or more classes get their vectors, in the precision of the column.

    Null, empty, zero, or non-finite vectors, null components and null labels: no links, own component.
    Vectors of different lengths never link. Repeated rows count as rows and are all returned; rows with one id but different
    vectors are linked by their vectors only. A null id keeps its row, with n_links counted, and names no component: the
    smallest id that is not null does. Where there is none, component_id is null and the row is kept. Empty input: no rows.
    """
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    keyed = ids_for_python(rows).mapInPandas(lean(_classes(kind)), "id long, id_none boolean, label string, digest binary, data binary")
    keyed = saved(ids_from_python(keyed), "vectors")
    classes = (
        keyed.where("digest is not null").groupBy("digest")
        .agg(F.first("label").alias("label"), F.min("id").alias("least"), F.count("*").alias("size"), F.first("data").alias("data"))
    )
    # numbers of their own: ids may be null or name several vectors. Saved, so that they stay as they are
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label", F.length("data")).count().agg(F.max("count")).first()[0] or 0
    how = (*plan(largest, threshold), seed)
    buckets = classes.select("label", "node", "data").mapInPandas(lean(_buckets(how, kind)), "node long, slot int, bucket long")
    buckets = saved(buckets, "buckets")
    # buckets of one class have no pair; large ones are cut into blocks
    sizes = buckets.groupBy("bucket", "slot").count().where(F.col("count") > 1)
    sizes = saved(sizes.select("bucket", "slot", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "sizes")
    cut = buckets.join(small(sizes), ["bucket", "slot"])
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("bucket", "slot", "node", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    cut = cut.join(classes.select("node", "label", "size", "data", F.length("data").alias("dim")), "node")
    together = cut.repartition("bucket", "slot", "p", "q").sortWithinPartitions(*_GROUP)
    found = saved(together.mapInPandas(lean(_pairs(threshold, how, kind)), "node long, links long, a long, b long"), "links")
    links = saved(found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links")), "counts")
    roots = saved(components(found.where("a is not null").select("a", "b")).withColumnRenamed("component", "root"), "roots")
    result = classes.select("digest", "node", "size", "least").join(links, "node", "left").join(roots, "node", "left")
    result = saved(result.select("digest", "size", "links", "least", F.coalesce("root", "node").alias("root")), "result")
    tops = saved(result.groupBy("root").agg(F.min("least").alias("top")), "tops")
    result = saved(result.join(tops, "root").select("digest", "size", "links", "top"), "result")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("top"))
    return keyed.select("id", "digest").join(result, "digest", "left").select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("size") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), component.isNull()).alias("kept"),
    )
