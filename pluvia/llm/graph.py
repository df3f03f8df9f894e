"""Connected components of an edge table, without bringing links or components to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import checkpointed, lean, saved


def forest(pairs) -> dict[int, int]:
    """Root (the smallest node reached) of each node of the given pairs."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (y := up.setdefault(top, top)) != top:
            top = y
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch, replaces links by stars around each smallest node: never more rows, same components."""
    for batch in batches:
        roots = forest(zip(batch["a"].tolist(), batch["b"].tolist(), strict=True))
        stars = [(x, r) for x, r in roots.items() if x != r]
        yield pd.DataFrame(stars, columns=["a", "b"]).astype("int64")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b long): component is the smallest node reachable.

    Alternates large-star and small-star steps, which end after about log^2 of the longest path. Each
    step is a grouped minimum (combined before the shuffle), saved, and a join that adaptive execution may split, so
    a node with very many links doesn't gather in one task. Loops and null ends are ignored.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    e = checkpointed(e.mapInPandas(lean(_contract), "a long, b long").distinct())
    state = None
    for _ in range(rounds):
        both = e.union(e.select("b", "a"))
        # saved, so that the joins stand on plain exchanges and a node with very many links can be split
        least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        down = saved(down, "down")
        least = saved(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        stars = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = checkpointed(stars.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )
