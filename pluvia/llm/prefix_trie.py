"""The prefix trie of rebuilt conversations, by fingerprints that compose.

A rebuilt conversation is the head of its base conversation and the rest of its own turns. Its prefixes have polynomial fingerprints modulo
2^61 - 1, in two lanes. Sequences under concatenation are a monoid, and fingerprints follow it: fp(xy) = fp(x) B^|y| + fp(y). So the prefixes
of a rebuilt conversation are worked out from those of its base and its own, P_base(h) B^(i-h) + (P_own(i) - P_own(h) B^(i-h)); no rebuilt
text is ever made. A prefix refers to its last turn as stored, by the class of its role and text.

Equality is checked, not assumed: a class of turns must hold one role and text, and prefixes of one fingerprint must agree in
the class of their last turn and in the fingerprint one turn before, which gives equal sequences by induction over their length. If a check fails
(two different sequences met in 122 bits), all is done again with other bases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pluvia.llm.common import lean, running_total, saved, small

PRIME = (1 << 61) - 1
WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "f1", "f2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def bases(attempt: int) -> tuple[int, int]:
    rng = np.random.default_rng([13, attempt])
    return tuple(int(x) for x in rng.integers(1 << 40, PRIME, 2))


def _scanned(base: tuple[int, int]):
    """Place, fingerprints of each prefix and of the one before, of sorted turns. Per partition: what its last conversation has reached."""
    b1, b2 = base

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, pos, p1, p2 = None, 0, 0, 0
        for batch in batches:
            out = []
            for conv, t1, t2 in zip(batch["conv"].tolist(), batch["t1"].tolist(), batch["t2"].tolist(), strict=True):
                if conv != now:
                    now, pos, p1, p2 = conv, 0, 0, 0
                before = (p1, p2)
                pos, p1, p2 = pos + 1, (p1 * b1 + (t1 % PRIME)) % PRIME, (p2 * b2 + (t2 % PRIME)) % PRIME
                out.append((pos, p1, p2, *before))
            found = pd.DataFrame(out, columns=["pos", "p1", "p2", "q1", "q2"], dtype="int64")
            yield pd.concat([batch.reset_index(drop=True), found], axis=1)

    return run


def _moved(base: tuple[int, int], starts: dict[int, tuple[int, int, int, int]]):
    """Puts what earlier partitions hold of a conversation before the prefixes of a partition that begins within it."""
    b1, b2 = base

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, rows in batch.groupby("part"):
                start = starts.get(int(part))
                if start is None:
                    yield rows.drop(columns="part")
                    continue
                conv, pos, p1, p2 = start
                mine = (rows["conv"] == conv).to_numpy()
                if not mine.any():  # an assignment of nothing would turn the column to doubles
                    yield rows.drop(columns="part")
                    continue
                for lane, b, p in ((1, b1, p1), (2, b2, p2)):
                    for name, back in ((f"p{lane}", 0), (f"q{lane}", 1)):
                        own = rows.loc[mine, name].tolist()
                        rows.loc[mine, name] = [(p * pow(b, n - back, PRIME) + x) % PRIME for n, x in zip(rows.loc[mine, "pos"].tolist(), own, strict=True)]
                rows.loc[mine, "pos"] += pos
                yield rows.drop(columns="part")

    return run


_TURN = "conv long, t1 long, t2 long, words long"


def turn_prefixes(turns: DataFrame, base: tuple[int, int]) -> DataFrame:
    """conv, t1, t2, words, pos, p1, p2 (fingerprint up to here), q1, q2 (one turn before) of turns (conv, turn, role, text and these).

    Turns are dealt by range, so a conversation may span partitions; one row per partition reaches the driver and joins the spans.
    """
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    ranged = turns.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", "t1", "t2", "words")
    full = f"{_TURN}, pos long, p1 long, p2 long, q1 long, q2 long"
    local = saved(ranged.mapInPandas(lean(_scanned(base)), full).withColumn("part", F.spark_partition_id()), "turn-prefixes")
    ends = local.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "pos", "p1", "p2")).alias("last")).orderBy("part").collect()
    starts, carry = {}, None  # what has been reached of the conversation at the end of the partitions so far
    for r in ends:
        last = tuple(r["last"])
        if carry and r["first"] == carry[0]:
            starts[r["part"]] = carry
            if last[0] == carry[0]:
                last = (last[0], last[1] + carry[1], *((c * pow(b, last[1], PRIME) + x) % PRIME for c, b, x in zip(carry[2:], base, last[2:], strict=True)))
        carry = last
    if not starts:
        return local.drop("part")
    return saved(local.mapInPandas(lean(_moved(base, starts)), full), "turn-prefixes-whole")


def _composed(base: tuple[int, int]):
    """Fingerprints of rebuilt prefixes from the head's (a) and the own suffix: p at pos, o at the turn where the head ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            span = (batch["pos"] - batch["h"]).tolist()
            for lane, b in zip((1, 2), base, strict=True):
                head, own = batch[f"a{lane}"].tolist(), batch[f"o{lane}"].tolist()
                for name, back in ((f"p{lane}", 0), (f"q{lane}", 1)):
                    batch[name] = [(a * (m := pow(b, k - back, PRIME)) + p - o * m) % PRIME for a, o, p, k in zip(head, own, batch[name].tolist(), span, strict=True)]
            yield batch[["conv", "depth", "p1", "p2", "q1", "q2", "t1", "t2", "words"]]

    return run


def rebuilt_prefixes(turns: DataFrame, convs: DataFrame, base: tuple[int, int]) -> DataFrame:
    """conv, depth, f1, f2, g1, g2 (one turn before), t1, t2, words of every prefix of every rebuilt conversation, the empty one included.

    convs: conv, base and h. Head rows come from the base's first turns, the others from the conversation's own.
    """
    pre = turn_prefixes(turns, base)
    head = saved(pre.where("pos <= 3"), "heads")
    reach = head.groupBy("conv").agg(F.max("pos").alias("n"), *(F.max_by(f"p{lane}", F.when(F.col("pos") == k, 1)).alias(f"p{lane}_{k}") for lane in (1, 2) for k in (1, 2, 3)))
    reach = saved(reach, "reach")
    of_base = reach.select(F.col("conv").alias("base"), "n", *(F.col(f"p{lane}_{k}").alias(f"b{lane}_{k}") for lane in (1, 2) for k in (1, 2, 3)))
    known = convs.join(of_base, "base", "left").join(reach.drop("n"), "conv", "left")
    pick = lambda side, lane, at: F.when(at == 1, F.col(f"{side}{lane}_1")).when(at == 2, F.col(f"{side}{lane}_2")).when(at == 3, F.col(f"{side}{lane}_3")).otherwise(0)
    taken = F.least("h", F.coalesce("n", F.lit(0)))
    known = known.select("conv", "base", "h", taken.alias("taken"), *(F.coalesce(pick("b", lane, taken), F.lit(0)).alias(f"a{lane}") for lane in (1, 2)), *(F.coalesce(pick("p", lane, F.col("h")), F.lit(0)).alias(f"o{lane}") for lane in (1, 2)))
    known = saved(known, "conversations")
    fields = ["depth", "f1", "f2", "g1", "g2", "t1", "t2", "words"]
    heads = known.select(F.col("conv").alias("id"), "base", "taken").join(head.withColumnRenamed("conv", "base"), "base").where(F.col("pos") <= F.col("taken"))
    heads = heads.select(F.col("id").alias("conv"), *(F.col(a).alias(b) for a, b in zip(["pos", "p1", "p2", "q1", "q2", "t1", "t2", "words"], fields, strict=True)))
    own = pre.join(known.drop("base"), "conv").where(F.col("pos") > F.col("h")).withColumn("depth", F.col("taken") + F.col("pos") - F.col("h"))
    columns = ["conv", "depth", "pos", "h", *(f"{c}{lane}" for c in "paoqt" for lane in (1, 2)), "words"]
    own = own.select(*columns).mapInPandas(lean(_composed(base)), "conv long, depth long, p1 long, p2 long, q1 long, q2 long, t1 long, t2 long, words long")
    own = own.toDF("conv", *fields)
    zero = F.lit(0).cast("long")
    root = known.select("conv", *(zero.alias(f) for f in fields))
    return saved(root.unionByName(heads).unionByName(own), "prefixes")


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of one node in a batch of sorted rows, as comma-joined text."""
    for at, batch in enumerate(batches):
        if not len(batch):
            continue
        new = (batch[_NODE] != batch[_NODE].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        ids = batch["conv"].astype("str").tolist()
        out = batch.iloc[starts][[*_NODE, "part"]].copy()
        out["batch"] = at
        out["ids"] = [",".join(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(batch)], strict=True)]
        yield out


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's texts, which come in order; only the digest's state is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for depth, f1, f2, ids in zip(*(batch[c].tolist() for c in [*_NODE, "ids"]), strict=True):
            if node == (depth, f1, f2):
                state.update(("," + ids).encode())
                continue
            if node:
                done.append((*node, state.hexdigest()))
            node, state = (depth, f1, f2), hashlib.sha256(ids.encode())
        yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"]).astype({c: "int64" for c in _NODE})
    if node:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*_NODE, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, f1, f2, ends_sha256 of rows (conv, depth, f1, f2): the digest of each node's ids in rising order.

    Ids are dealt by range and packed where they lie, a batch at a time, so even a node of a third of all rows reaches its last task as
    few rows. That task streams them: a digest of one text can't be made in parallel, but holds no more than its state.
    """
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_NODE, "conv"]
    dealt = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    packed = saved(dealt.mapInPandas(lean(_packed), "depth long, f1 long, f2 long, part int, batch int, ids string"), "packed-ends")
    streamed = packed.repartition(*_NODE).sortWithinPartitions(*_NODE, "part", "batch")
    return streamed.mapInPandas(lean(_digested), "depth long, f1 long, f2 long, ends_sha256 string")


def _same_turns(turns: DataFrame) -> bool:
    """Whether each class of turns holds one role and text."""
    both = F.struct("role", "text")
    kinds = turns.groupBy("t1", "t2").agg(F.min(both).alias("a"), F.max(both).alias("b"))
    return kinds.where("a <> b").isEmpty()


def conversation_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", group: int = 20) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are ordered by turn, null first; of equal turns by role, then text. Conversation c is rebuilt from the first h turns of c - c % group and its own
    turns after its first h, h = crc32 of the decimal c, modulo 4. Null roles and texts are empty. Rows without a conv_id belong to no conversation
    and are left out. Equal rows are turns of their own. Other columns are not read. Empty input: no rows, since the root has members only if there are any.
    """
    nothing = F.lit("")
    clean = rows.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), nothing).alias("role"), F.coalesce(F.col(text_col), nothing).alias("text")).where("conv is not null")
    clean = clean.withColumn("row", F.monotonically_increasing_id())
    convs = clean.select("conv").distinct().select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int").alias("h"))
    convs = saved(convs, "conv-ids")
    for attempt in range(8):
        keyed = clean.select(
            "*", F.xxhash64(F.lit(attempt), "role", "text").alias("t1"), F.xxhash64(F.lit(-1 - attempt), "text", "role").alias("t2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
        )
        prefixes = rebuilt_prefixes(keyed, convs, bases(attempt))
        agree = [c for name in ("g1", "g2", "t1", "t2") for c in (F.min(name).alias(name), F.max(name).alias(f"{name}_"))]
        nodes = saved(prefixes.groupBy(*_NODE).agg(F.min("conv").alias("rep"), F.count("*").alias("n_convs"), F.max("words").alias("words"), *agree), "nodes")
        apart = nodes.where("g1 <> g1_ or g2 <> g2_ or t1 <> t1_ or t2 <> t2_")
        if _same_turns(keyed) and apart.isEmpty():
            break
    else:
        raise RuntimeError("fingerprints of different conversations keep meeting")
    nodes = nodes.withColumn("v", (F.col("n_convs") - 1) * F.col("words"))
    up = (F.col("depth") - 1).alias("depth")
    children = saved(nodes.where("depth > 0").groupBy(up, F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.count("*").alias("n_children")), "children")
    # nodes on the chain of their representative: the sum of v before each, from which those of subtrees follow
    summed = saved(running_total(nodes.select(*_NODE, "rep", "v"), ["rep", "depth"], "v", "before"), "chains")
    linked = saved(nodes.join(children, _NODE, "left").join(summed.drop("rep", "v"), _NODE), "linked")
    chain = linked.groupBy("rep").agg(F.min("before").alias("begin"), F.sum("v").alias("total"), F.count_if(F.col("n_children").isNull()).alias("leaves"))
    chain = saved(chain, "chain-sums")
    totals = prefixes.select("conv", *_NODE).join(small(chain.select(F.col("rep").alias("conv"), "total", "leaves")), "conv", "left")
    totals = saved(totals, "totals").groupBy(*_NODE).agg(F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"))
    last = prefixes.groupBy("conv").agg(F.max_by(F.struct(*_NODE), "depth").alias("end")).select("conv", "end.*")
    digests = end_digests(saved(last, "ends"))
    # the parent of a node that isn't the first on its chain is the node before it
    parents = small(saved(nodes.join(children.select(*_NODE), _NODE).select(F.col("depth").alias("pd"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("rep").alias("parent_conv_id")), "parents"))
    whole = linked.join(saved(totals, "subtrees"), _NODE).join(saved(digests, "digests"), _NODE, "left").join(small(chain.select("rep", "begin")), "rep")
    whole = saved(whole.withColumn("pd", F.col("depth") - 1), "whole").join(parents, ["pd", "g1", "g2"], "left")
    return whole.select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("total") - (F.col("before") - F.col("begin"))).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
