"""Exact search for the largest inner products in M-trees, best first.

Vectors become whole numbers, floor(scale x). They are dealt to chunks around sampled pivots; each chunk is an M-tree whose nodes are
pages, rows of one table: routing vectors with covering radius and the distance to the routing vector of the page above, or, in leaves, the
vectors with that distance. Searches take pages by the best product they may hold. Two bounds on the product of a query q with
anything within r of c follow from the triangle inequality of the Euclidean distance d and the largest norm m below c:

    q.x <= q.c + |q| r        q.x <= (|q|^2 + m^2 - max(0, d(q, c) - r)^2) / 2

With the distances stored in the page, |d(q, parent) - d(parent, c)| stands for d(q, c) at first, so products are worked out only for entries that
this does not rule out. A first round searches the most promising chunk of each query, the second the chunks that may still better the k-th product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pluvia.llm.common import lean, saved, small

#: Rows of a chunk and of a page, and the most chunks that are meant: beyond, chunks get larger.
CHUNK_ROWS, PAGE_ROWS, MOST_CHUNKS = 1024, 128, 16_384
#: Queries that share one copy of a chunk.
BLOCK_QUERIES = 2048
#: Vectors whose norm after scaling is at least this take no part: their products need not fit 64 bits.
MOST_NORM = 2.0**31
_LAST = 2**63 - 1
CHUNK = ["dim", "cell", "part"]
_KEYS = "dim int, cell int, part int"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """row (a number of its own), id, key (id, or the largest long where null), dim and v: whole numbers. Vectors that take no part are left out."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < MOST_NORM / scale))
    whole = vectors.where(x.isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    whole = whole.where(norm < MOST_NORM**2)
    return saved(whole.select(F.monotonically_increasing_id().alias("row"), "id", F.coalesce("id", F.lit(_LAST)).alias("key"), F.size("v").alias("dim"), "v"), "whole-vectors")


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(x.astype("float64") - y).sum(axis=-1))


def _stack(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.tolist(), dtype="int64").reshape(len(column), dim)


def _by_dim(batch: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for dim, part in batch.groupby("dim", sort=True):
        yield int(dim), part, _stack(part["v"], int(dim))


def _dealt(pivots: dict[int, np.ndarray]):
    """Adds the number of the nearest pivot of the same length, -1 where there is none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part, v in _by_dim(batch):
                cell = np.full(len(part), -1, dtype="int32")
                if (p := pivots.get(dim)) is not None and dim:
                    for at in range(0, len(v), 4096):
                        x = v[at : at + 4096].astype("float64")
                        cell[at : at + 4096] = np.argmin(np.square(p).sum(axis=1) - 2 * (x @ p.T), axis=1)
                yield part.assign(cell=cell)

    return run


def grow(v: np.ndarray, keys: np.ndarray, rows: np.ndarray, page_rows: int = PAGE_ROWS, seed: int = 5) -> tuple[np.ndarray, float, list[dict]]:
    """(centre, radius, pages) of an M-tree; pages[0] is the root. Every vector is in one leaf."""
    rng, pages = np.random.default_rng(seed), []
    norms = np.sqrt(np.square(v.astype("float64")).sum(axis=1))

    def page(members: np.ndarray, above: np.ndarray) -> int:
        at = len(pages)
        pages.append({})
        if len(members) <= page_rows:
            x = v[members]
            pages[at] = {"leaf": True, "v": x, "apart": _distance(x, above), "norm": norms[members], "key": keys[members], "row": rows[members]}
            return at
        n = min(page_rows, -(-len(members) // page_rows) * 2)
        routing = rng.choice(members, n, replace=False)
        near = np.argmin(np.stack([_distance(v[members], v[r]) for r in routing], axis=1), axis=1)
        groups = [(int(r), members[near == k]) for k, r in enumerate(routing) if (near == k).any()]
        if len(groups) == 1:  # equal vectors: any split serves
            groups = [(int(g[0]), g) for g in np.array_split(members, n)]
        entries = []
        for r, group in groups:
            away = _distance(v[group], v[r])
            entries.append((r, float(away.max()), float(norms[group].max()), page(group, v[r])))
        r = np.array([e[0] for e in entries])
        pages[at] = {"leaf": False, "v": v[r], "apart": _distance(v[r], above), "radius": np.array([e[1] for e in entries]), "norm": np.array([e[2] for e in entries]), "child": np.array([e[3] for e in entries])}
        return at

    middle = v[np.argmin(_distance(v, v.mean(axis=0)))] if len(v) else np.zeros(v.shape[1])
    page(np.arange(len(v)), middle)
    return middle, float(_distance(v, middle).max(initial=0.0)), pages


def bound(product, distance, q_norm: float, radius, norm):
    """The largest product that something within `radius` of a vector at this product and distance may have."""
    low = np.maximum(0.0, distance - radius)
    return np.minimum(product + q_norm * radius, (q_norm**2 + np.square(norm) - np.square(low)) / 2)


def search(pages: list[dict], middle: np.ndarray, radius: float, q: np.ndarray, own: int, k: int, least: float = -np.inf) -> tuple[list[tuple[int, int, int]], int]:
    """([(score, key, row)], products worked out): the k best rows but `own`, of those that reach `least`; ties to the smaller key, then row."""
    q_norm = float(np.sqrt(np.square(q.astype("float64")).sum()))
    largest = max(float(p["norm"].max(initial=0.0)) for p in pages)
    slack = 1e-9 * (q_norm + largest) ** 2  # rounding of the bounds
    exact = "float64" if q_norm * largest < 2.0**52 else "int64"  # sums of whole numbers below 2^53 are exact in doubles
    qx = q.astype(exact)
    best: list[tuple[int, int, int]] = []
    kth, worked = least, 1
    product, away = float(middle.astype("float64") @ q.astype("float64")), float(_distance(middle, q))
    heap = [(-float(bound(product, away, q_norm, radius, largest)), 0, product, away)]
    while heap:
        top, at, product, away = heapq.heappop(heap)
        if -top + slack < kth:
            break
        p = pages[at]
        reach = 0.0 if p["leaf"] else p["radius"]
        low = np.maximum(0.0, np.abs(away - p["apart"]) - reach)
        most = np.minimum(product + q_norm * (p["apart"] + reach), (q_norm**2 + np.square(p["norm"]) - np.square(low)) / 2)
        open_ = np.flatnonzero(most + slack >= kth)
        if not len(open_):
            continue
        worked += len(open_)
        x = p["v"][open_]
        products = x.astype(exact) @ qx
        if p["leaf"]:
            found = [(int(s), int(i), int(r)) for s, i, r in zip(products.tolist(), p["key"][open_].tolist(), p["row"][open_].tolist(), strict=True) if s >= kth and r != own]
            if found:
                best = sorted(best + found, key=lambda t: (-t[0], t[1], t[2]))[:k]
                if len(best) == k:
                    kth = max(kth, best[-1][0])
            continue
        away_each = _distance(x, q)
        may = bound(products.astype("float64"), away_each, q_norm, p["radius"][open_], p["norm"][open_])
        for i in np.flatnonzero(may + slack >= kth).tolist():
            heapq.heappush(heap, (-float(may[i]), int(p["child"][open_[i]]), float(products[i]), float(away_each[i])))
    return best, worked


PAGES = f"{_KEYS}, page int, leaf boolean, n int, middle binary, radius double, v binary, apart binary, norm binary, radii binary, child binary, keys binary, rows binary"


def _grown(page_rows: int):
    def run(key: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        dim, cell, part = (int(x) for x in key)
        chunk = chunk.sort_values("row")
        middle, radius, pages = grow(_stack(chunk["v"], dim), chunk["key"].to_numpy("int64"), chunk["row"].to_numpy("int64"), page_rows)
        rows = []
        for i, p in enumerate(pages):
            data = {c: (p[s].astype(t).tobytes() if s in p else None) for c, s, t in (("v", "v", "<i8"), ("apart", "apart", "<f8"), ("norm", "norm", "<f8"), ("radii", "radius", "<f8"), ("child", "child", "<i4"), ("keys", "key", "<i8"), ("rows", "row", "<i8"))}
            rows.append({"dim": dim, "cell": cell, "part": part, "page": i, "leaf": p["leaf"], "n": len(p["v"]), "middle": middle.astype("<i8").tobytes() if i == 0 else None, "radius": radius, **data})
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")])

    return run


def _loaded(table: pd.DataFrame, dim: int) -> list[dict]:
    pages = []
    for p in table.sort_values("page").to_dict("records"):
        page = {"leaf": bool(p["leaf"]), "v": np.frombuffer(p["v"], "<i8").reshape(p["n"], dim), "apart": np.frombuffer(p["apart"], "<f8"), "norm": np.frombuffer(p["norm"], "<f8")}
        if p["leaf"]:
            page |= {"key": np.frombuffer(p["keys"], "<i8"), "row": np.frombuffer(p["rows"], "<i8")}
        else:
            page |= {"radius": np.frombuffer(p["radii"], "<f8"), "child": np.frombuffer(p["child"], "<i4")}
        pages.append(page)
    return pages


def build_trees(whole: DataFrame, chunk_rows: int = CHUNK_ROWS, page_rows: int = PAGE_ROWS) -> tuple[DataFrame, dict]:
    """(pages, tops): the table of pages, and per length the keys, centres, radii and largest norms of all chunks, at most about three per pivot.

    Pivots are a sample of one row in `chunk_rows` (at most MOST_CHUNKS), which decides only how rows are dealt. A pivot with
    more rows, such as copies of one vector, is cut into several chunks.
    """
    n = whole.count()
    chunk_rows = max(chunk_rows, -(-n // MOST_CHUNKS))
    sample = whole.orderBy(F.xxhash64("row"), "row").limit(max(1, -(-n // chunk_rows))).select("dim", "v").toPandas()
    pivots = {dim: v.astype("float64") for dim, _, v in _by_dim(sample)} if len(sample) else {}
    cells = whole.select("row", "key", "dim", "v").mapInPandas(lean(_dealt(pivots)), "row long, key long, dim int, v array<long>, cell int")
    cells = saved(cells, "cells")
    parts = small(saved(cells.groupBy("dim", "cell").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("parts")), "parts"))
    dealt = cells.join(parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    pages = saved(dealt.select(*CHUNK, "row", "key", "v").groupBy(*CHUNK).applyInPandas(_grown(page_rows), PAGES), "m-trees")
    tops: dict[int, tuple] = {}
    roots = pages.where("page = 0").select(*CHUNK, "middle", "radius", "norm").toPandas()
    for dim, part in roots.groupby("dim"):
        middle = np.stack([np.frombuffer(m, "<i8") for m in part["middle"]]).astype("float64")
        tops[int(dim)] = (part[["cell", "part"]].to_numpy("int32"), middle, part["radius"].to_numpy(), np.array([np.frombuffer(x, "<f8").max() for x in part["norm"]]))
    return pages, tops


def _routed(tops: dict, first: bool):
    """The chunks that each query is sent to: the most promising one, or the others that may still reach its k-th product."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part, v in _by_dim(batch):
                keys, middle, radius, norm = tops[dim]
                for at in range(0, len(part), 256):
                    some, q = part.iloc[at : at + 256], v[at : at + 256].astype("float64")
                    q_norm = np.sqrt(np.square(q).sum(axis=1))[:, None]
                    product = q @ middle.T
                    away = np.sqrt(np.maximum(0.0, q_norm**2 + np.square(middle).sum(axis=1) - 2 * product))
                    away = np.maximum(0.0, away - 1e-6 * (q_norm + norm))  # the difference of squares may lose digits
                    may = bound(product, away, q_norm, radius, norm)
                    best = np.argmax(may, axis=1)
                    if first:
                        i, j = np.arange(len(some)), best
                    else:
                        open_ = may + 1e-9 * (q_norm + norm) ** 2 >= some["least"].to_numpy()[:, None]
                        open_[np.arange(len(some)), best] = False
                        i, j = np.nonzero(open_)
                    yield some.iloc[i].assign(cell=keys[j, 0], part=keys[j, 1])

    return run


def _searched(k: int):
    def run(key: tuple, pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pages) and len(queries):
            dim = int(key[0])
            root = pages[pages["page"] == 0].iloc[0]
            middle, tree = np.frombuffer(root["middle"], "<i8"), _loaded(pages, dim)
            for row, v, least in zip(queries["row"].tolist(), queries["v"], queries["least"].tolist(), strict=True):
                best, _ = search(tree, middle, float(root["radius"]), np.asarray(v, dtype="int64"), row, k, least)
                out += [(row, s, i, r) for s, i, r in best]
        return pd.DataFrame(out, columns=["query", "score", "key", "row"]).astype("int64")

    return run


def largest_products(vectors: DataFrame, is_query: Column | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, chunk_rows: int = CHUNK_ROWS, page_rows: int = PAGE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k other rows of the largest inner product of floor(scale x), ties to the smaller id.

    is_query is a condition on `id`; by default ids divisible by 100. The result is exact.

    Null vectors, null or non-finite components and vectors whose scaled norm reaches 2^31 take no part. Only vectors of the query's length are
    candidates. A null id is no query; as a candidate it comes after all ids of the same score and is returned as null. Repeated ids are rows
    of their own: each is a query, and a candidate of the others. Fewer than k candidates: all. An empty table gives no rows.
    """
    whole = whole_vectors(vectors, id_col, vector_col, scale)
    pages, tops = build_trees(whole, chunk_rows, page_rows)
    queries = saved(whole.where(is_query if is_query is not None else F.col("id") % 100 == 0).select("row", "dim", "v"), "queries")
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    to = "row long, dim int, v array<long>, block int, least double, cell int, part int"

    def answers(asked: DataFrame, first: bool, name: str) -> DataFrame:
        sent = saved(asked.mapInPandas(lean(_routed(tops, first)), to), f"sent-{name}")
        wanted = saved(sent.select(*CHUNK, "block").distinct(), "wanted")
        copies = pages.join(wanted, CHUNK)
        keys = [*CHUNK, "block"]
        return saved(copies.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(_searched(k), "query long, score long, key long, row long"), f"found-{name}")

    near = answers(queries.withColumn("least", F.lit(float("-inf"))), True, "first")
    reached = near.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("reached"))
    asked = queries.join(reached, queries["row"] == reached["query"], "left").withColumn("least", F.coalesce("reached", F.lit(float("-inf"))))
    rest = answers(asked.select("row", "dim", "v", "block", "least"), False, "rest")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key", "row")
    best = saved(near.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    named, asking = whole.select("row", F.col("id").alias("vec_id")), whole.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return best.join(named, "row").join(asking, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
