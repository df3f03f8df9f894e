"""Exact k nearest neighbours by a k-d partition of the right side.

A bounded sample of the right side's midpoints gives the splits, so parts are small where rows are dense. Each part keeps the box of what it
really holds and how many features have their first row in it. A left row first meets the part that lies nearest; the k-th distance
found there (or before it the farthest corner of a box that holds k features) bounds the second round, in which it meets
only the parts whose boxes are within that. Splits and boxes are what reaches tasks: at most 2^MOST_DEPTH parts. Left rows at one
place are searched once, and what is found there is joined to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.sources.rounds import settled

#: Rows that a part is meant to hold, the most splits on the way to one, and the sampled rows for each part.
PART_ROWS, MOST_DEPTH, SAMPLE_PER_PART = 64, 16, 8


class Parts:
    """Splits of space, in the order of a heap, and the boxes of the parts; parts of one group lie in one subtree."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, n = depth, (1 << depth) - 1
        self.axis, self.at = np.zeros(n, dtype="int64"), np.full(n, np.inf)
        held = {0: sample}
        for node in range(n):
            x = held.pop(node)
            if len(x):
                self.axis[node] = int(np.argmax(x.max(axis=0) - x.min(axis=0))) if len(x) < 3 else int(np.argmax(np.diff(np.quantile(x, [0.1, 0.9], axis=0), axis=0)[0]))
                self.at[node] = np.median(x[:, self.axis[node]])
            right = x[:, self.axis[node]] > self.at[node] if len(x) else np.zeros(0, dtype=bool)
            if 2 * node + 2 < n:
                held[2 * node + 1], held[2 * node + 2] = x[~right], x[right]

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype="int64")
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.at[node])
        return node - ((1 << self.depth) - 1)

    def boxed(self, rows: list, dims: int) -> Parts:
        """rows: (part, lows.., highs.., features) of the parts that hold anything."""
        n = 1 << self.depth
        self.low, self.high, self.homes = np.full((n, dims), np.inf), np.full((n, dims), -np.inf), np.zeros(n, dtype="int64")
        for part, *box in rows:
            self.low[part], self.high[part], self.homes[part] = box[:dims], box[dims : 2 * dims], box[2 * dims]
        self.each = 1 << (self.depth // 2)
        group = lambda a, how: how(a.reshape(-1, self.each, *a.shape[1:]), axis=1)
        self.group_low, self.group_high, self.group_homes = group(self.low, np.min), group(self.high, np.max), group(self.homes, np.sum)
        return self


def _apart(low: np.ndarray, high: np.ndarray, to_low: np.ndarray, to_high: np.ndarray) -> np.ndarray:
    """Least distance of two boxes; infinite to an empty one."""
    return np.sqrt(np.square(np.maximum(0.0, np.maximum(to_low - high, low - to_high))).sum(axis=-1))


def _across(low: np.ndarray, high: np.ndarray, to_low: np.ndarray, to_high: np.ndarray) -> np.ndarray:
    """Largest distance of two boxes."""
    return np.sqrt(np.square(np.maximum(to_high - low, high - to_low)).sum(axis=-1))


def sent(parts: Parts, low: np.ndarray, high: np.ndarray, k: int, limit: float, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, part): without `reach` the part that each row meets first, else all others within min(reach, limit)."""
    lo, hi = low[:, None], high[:, None]
    near = _apart(lo, hi, parts.group_low, parts.group_high)
    far = np.where(parts.group_homes >= k, _across(lo, hi, parts.group_low, parts.group_high), np.inf)
    whole = _across(low, high, parts.group_low.min(axis=0), parts.group_high.max(axis=0))
    bound = np.minimum(np.minimum(far.min(axis=1), whole), limit)
    best = np.argmin(near, axis=1)
    inside = best[:, None] * parts.each + np.arange(parts.each)
    full = parts.homes[inside] >= k
    there = np.where(full, _apart(lo, hi, parts.low[inside], parts.high[inside]), np.inf)
    bound = np.minimum(bound, np.where(full, _across(lo, hi, parts.low[inside], parts.high[inside]), np.inf).min(axis=1))
    slot = np.argmin(there, axis=1)
    first = np.where(np.isfinite(there[np.arange(len(low)), slot]), inside[np.arange(len(low)), slot], -1)
    if reach is None:
        row = np.flatnonzero(first >= 0)
        return row, first[row]
    bound = np.minimum(bound, reach) * (1 + 1e-9) + 1e-9
    row, group = np.nonzero(near <= bound[:, None])
    out: tuple[list, list] = ([], [])
    for at in range(0, len(row), 4096):
        r, part = row[at : at + 4096], group[at : at + 4096, None] * parts.each + np.arange(parts.each)
        i, j = np.nonzero((_apart(lo[r], hi[r], parts.low[part], parts.high[part]) <= bound[r, None]) & (part != first[r, None]))
        out[0].append(r[i])
        out[1].append(part[i, j])
    return (np.concatenate(out[0]), np.concatenate(out[1])) if row.size else (np.zeros(0, dtype="int64"),) * 2


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch[c].to_numpy(zero_copy_only=False) for c in names], axis=1) if batch.num_rows else np.zeros((0, len(names)))


def _router(parts: Parts, dims: int, k: int, limit: float, first: bool):
    low, high = [f"_l{i}" for i in range(dims)], [f"_h{i}" for i in range(dims)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                reach = None if first else np.nan_to_num(batch["_reach"].to_numpy(zero_copy_only=False).astype(float), nan=np.inf)
                row, part = sent(parts, _columns(batch, low), _columns(batch, high), k, limit, reach)
                yield batch.take(pa.array(row)).append_column("_part", pa.array(part, pa.int64()))

    return run


def nearest_by_parts(
    left: DataFrame, key: str, right: DataFrame, other: str, corners: list[tuple[str, ...]], distance: Column, k: int, limit: float = math.inf, apart: Column | None = None, part_rows: int | None = None
) -> DataFrame:
    """(key, other, d, r): the k nearest features of each feature of the left side within `limit`, ties by id; fewer where there are fewer.

    Both sides have one row per piece of a feature. corners: for each dimension the columns of the left side between whose least and greatest
    value the piece lies; the right side has the same with the prefix `o`. distance is the distance of two pieces, never below that of their
    boxes. apart: a condition on pairs (such as key <> other), which may rule out one feature at most. Only the k (one more with `apart`) smallest ids of
    equal pieces on the right are searched, since the others can't be among the nearest.
    """
    spark, dims = left.sparkSession, len(corners)
    spread = k + (apart is not None)
    pieces = [c for axis in corners for c in axis]
    bounds = lambda prefix: [f(*[F.col(prefix + c) for c in axis]) if len(axis) > 1 else F.col(prefix + axis[0]) for f in (F.least, F.greatest) for axis in corners]
    names = [f"_l{i}" for i in range(dims)] + [f"_h{i}" for i in range(dims)]
    same = Window.partitionBy(*["o" + c for c in pieces]).orderBy(other)
    once = right.select(other, *["o" + c for c in pieces]).distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= spread).drop("_n")
    once = settled(once.select("*", *[b.alias(n) for b, n in zip(bounds("o"), names, strict=True)]))
    total = once.count()
    types = {f.name: f.dataType.simpleString() for f in [*left.schema, *right.schema]}
    nothing = spark.createDataFrame([], f"`{key}` {types[key]}, `{other}` {types[other]}, d double, r int")
    if not total:
        return nothing
    depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(total / (part_rows or PART_ROWS)))))
    middles = [((F.col(f"_l{i}") + F.col(f"_h{i}")) / 2).alias(f"m{i}") for i in range(dims)]
    wanted = SAMPLE_PER_PART << depth
    picked = once.select(*middles) if total <= wanted else once.select(*middles).sample(min(1.0, wanted / total), seed=3)
    parts = Parts(np.array([list(r) for r in picked.collect()], dtype=float).reshape(-1, dims), depth)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            middle = (_columns(b, names[:dims]) + _columns(b, names[dims:])) / 2
            yield b.append_column("_part", pa.array(parts.of(middle), pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in once.schema)
    placed = settled(once.mapInArrow(dealt, schema + ", _part long"))
    homes = placed.groupBy(other).agg(F.min("_part").alias("_part")).groupBy("_part").agg(F.count("*").alias("_homes"))
    boxes = placed.groupBy("_part").agg(*[F.min(f"_l{i}") for i in range(dims)], *[F.max(f"_h{i}") for i in range(dims)]).join(homes, "_part", "left").fillna(0, subset=["_homes"])
    parts.boxed([list(r) for r in boxes.collect()], dims)
    spread = min(spread, int(parts.homes.sum()))
    # known not to be null, the pieces' distance compiles to code that the JVM optimises
    there = " and ".join(f"{{0}}{c} is not null" for c in pieces)
    target = placed.where(there.format("o")).select("_part", other, *["o" + c for c in pieces])
    # left rows at one place ask once, for as many as any of them may need
    places = settled(left.where(there.format("")).select(*pieces).distinct()).withColumn("_place", F.monotonically_increasing_id())
    asking = settled(places.select("_place", *pieces, *[b.alias(n) for b, n in zip(bounds(""), names, strict=True)]))
    routed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asking.schema)

    def met(rows: DataFrame) -> DataFrame:
        pairs = rows.where(there.format("")).join(target, "_part").withColumn("d", distance)
        # what is too far goes after the sums: a condition on d before them would be worked out a second time in the join
        least = pairs.groupBy("_place", other).agg(F.min("d").alias("d"), *([F.first("_reach").alias("_reach")] if "_reach" in rows.columns else []))
        near = least.where((F.col("d") <= limit) & (F.col("_reach").isNull() | (F.col("d") <= F.col("_reach")))) if "_reach" in rows.columns else least.where(F.col("d") <= limit)
        return near.select("_place", other, "d")

    def ranked(df: DataFrame, of: str, n: int) -> DataFrame:
        return df.withColumn("r", F.row_number().over(Window.partitionBy(of).orderBy("d", other))).where(F.col("r") <= n)

    near = settled(ranked(met(asking.mapInArrow(_router(parts, dims, spread, limit, True), routed + ", _part long")), "_place", spread))
    reach = near.where(F.col("r") == spread).select("_place", F.col("d").alias("_reach"))
    bounded = asking.join(reach, "_place", "left").select(*asking.columns, "_reach")
    rest = met(bounded.mapInArrow(_router(parts, dims, spread, limit, False), routed + ", _reach double, _part long"))
    both = ranked(near.drop("r").unionByName(rest).groupBy("_place", other).agg(F.min("d").alias("d")), "_place", spread)
    found = settled(asking.select("_place", *pieces).join(both, "_place").select(*pieces, other, "d"))
    pairs = left.select(key, *pieces).where(there.format("")).join(found, pieces)
    pairs = (pairs.where(apart) if apart is not None else pairs).select(key, other, "d")
    # dealt by key at once: the sums and the ranks of a feature then need no further exchange
    return nothing.unionByName(ranked(pairs.repartition(key).groupBy(key, other).agg(F.min("d").alias("d")), key, k))
