"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pluvia.llm.common import running_total, saved, small

#: Hex digits of the hash that each histogram level looks at, from the left; the last level looks at the rest.
LEVELS = (3, 3, 3, 23)


def water_fill(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds `target`: share x all sizes, dealt out by `weight`, no source above most x its size.

    `sources` (source_size, weight) is a saved table of one row per source. Each round caps the sources that
    are above and reshares the excess; only two sums per round reach the driver.
    """
    cap = F.col("source_size") * most
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    spent, open_weight, capped = 0.0, sources.agg(F.sum("weight")).first()[0] or 0, 0
    while True:
        level = (F.col("weight") * F.lit(budget - spent)) / F.lit(float(open_weight or 1))
        over = level > cap
        got = sources.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if got[2] == capped or not got[1]:
            return sources.withColumn("target", F.when(over, cap).otherwise(level).cast("double"))
        spent, open_weight, capped = got[0] or 0.0, got[1], got[2]


def _digest(id_col: str, text_col: str):
    """Of the id and the text, so that rows with null or repeated ids fall to different places."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.md5(text)))


def _size(text_col: str):
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): one row per document with its id, source, size and hash h, and one row per source with
    source_size, target, whole copies, and the hash `cut` below which (`with_cut`: or at which) one copy more is taken."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _size(text_col).alias("size"), _digest(id_col, text_col).alias("h"))
    sized = saved(sized, "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("none", F.col("source").isNull())
    ranked = running_total(sums.withColumn("one", F.lit(1)), ["none", "source"], "one", "rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    targets = water_fill(saved(ranked.select("source", "source_size", turn.alias("weight")), "sources"), share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("whole", whole.cast("int"))
    plan = saved(plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "plan")

    # the hash prefix in which each source's budget ends, and the words below it
    ends = plan.select("source", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("below"))
    at = 0
    for digits in LEVELS:
        inside = sized.alias("d").join(
            small(ends).alias("e"),
            F.col("d.source").eqNullSafe(F.col("e.source")) & (F.substring("h", 1, at) == F.col("prefix")),
        )
        bucket = F.concat("prefix", F.substring("h", at + 1, digits))
        hist = inside.groupBy("e.source", "rest", "below", bucket.alias("prefix")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("prefix"))
        first = hist.withColumn("upto", F.col("below") + upto).where("upto > rest").groupBy("source", "rest").agg(
            F.min(F.struct("prefix", "upto", "n")).alias("b")
        )
        ends = saved(first.select("source", "rest", F.col("b.prefix").alias("prefix"), (F.col("b.upto") - F.col("b.n")).alias("below"), F.col("b.upto").alias("upto")), "ends")
        keep_upto = ends
        ends = ends.drop("upto")
        at += digits
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")
    cuts = keep_upto.select("source", F.col("prefix").alias("cut"), nearer.alias("with_cut"))
    known = saved(
        plan.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select("p.source", "source_size", "target", "whole", "cut", "with_cut"), "cuts",
    )
    return sized, known


def copies(h, plan_alias: str = "k"):
    """How many copies the mix takes of a row with hash h, joined to its source's row of the plan."""
    cut = F.col(f"{plan_alias}.cut")
    below = (h < cut) | ((h == cut) & F.col(f"{plan_alias}.with_cut"))
    return (F.col(f"{plan_alias}.whole") + F.when(below, 1).otherwise(0)).cast("int")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per input row: id, size (words), source_size, target (of its source), taken (words), copies (0 to 2).

    Sources in code point order, null last, take the weights in turn. A source's target above its size means
    whole copies of all its documents, and the rest of the target is met by the documents whose hash lies
    below a threshold. Per source, sizes are summed by hash bucket, the bucket that the budget ends in is
    found, and only that bucket is split on; no document is sorted. Sums miss the target by half a document at most.

    The hash depends on the id and the text alone, so reruns agree; only rows that are equal in both are taken together.
    Null text has size 0, null ids hash as an empty string, null sources form one source. Empty input: no rows.
    """
    sized, plan = mix_plan(docs, id_col, text_col, source_col, **how)
    both = sized.alias("d").join(small(plan).alias("k"), F.col("d.source").eqNullSafe(F.col("k.source")))
    taken = (F.col("size") * F.col("copies")).cast("long")
    out = both.select(F.col("id").alias(id_col), "size", "source_size", "target", copies(F.col("h")).alias("copies"))
    return out.select(id_col, "size", "source_size", "target", taken.alias("taken"), "copies")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of docs with all their columns, as often as mix_sources takes them."""
    _, plan = mix_plan(docs, id_col, text_col, source_col, **how)
    rows = docs.select(F.struct("*").alias("_row"), F.col(source_col).alias("_source"), _digest(id_col, text_col).alias("_h"))
    both = rows.join(small(plan).alias("k"), F.col("_source").eqNullSafe(F.col("k.source")))
    many = both.select("_row", copies(F.col("_h")).alias("_n")).where("_n > 0")
    return many.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")
