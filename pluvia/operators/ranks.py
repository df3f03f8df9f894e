"""Row numbers, running counts and quantiles of whole tables without gathering them in one task: rows are dealt by ranges, each
range works on its own, and one number per range goes to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.sources.rounds import settled


def _ranged(df: DataFrame, order: list[str]) -> tuple[DataFrame, list[Column]]:
    """df in ranges of `order` (nulls first), with its range as _part; fixed, so that later steps see the same ranges."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id())), keys


def running(df: DataFrame, order: list[str], values: dict[str, Column]) -> DataFrame:
    """Adds, for each name in `values`, the sum of that column over all rows before the row in `order`. Rows that tie in the whole
    order share a range, so give an order with few ties (distinct keys with their counts)."""
    dealt, keys = _ranged(df, order)
    dealt = dealt.withColumns({f"_v{i}": v for i, v in enumerate(values.values())})
    sums = dealt.groupBy("_part").agg(*[F.sum(f"_v{i}").alias(f"s{i}") for i in range(len(values))]).orderBy("_part").collect()
    before, total = [], [0] * len(values)
    for r in sums:
        before.append((r["_part"], *total))
        total = [t + (r[f"s{i}"] or 0) for i, t in enumerate(total)]
    kinds = ", ".join(f"_b{i} {dealt.schema[f'_v{i}'].dataType.simpleString() if dealt.schema[f'_v{i}'].dataType.simpleString() == 'double' else 'long'}" for i in range(len(values)))
    base = df.sparkSession.createDataFrame(before, "_part int, " + kinds)  # one row per range
    w = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(base), "_part")
    for i, name in enumerate(values):
        out = out.withColumn(name, F.col(f"_b{i}") + F.coalesce(F.sum(f"_v{i}").over(w), F.lit(0)))
    return out.drop("_part", *[f"_{c}{i}" for i in range(len(values)) for c in "vb"])


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Adds `out`: 0, 1, 2.. in the order."""
    return running(df, order, {out: F.lit(1)})


def counted(df: DataFrame, col: str) -> DataFrame:
    """(col, _n, _below): distinct values that aren't null, how many rows have each and how many a smaller one."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
    return running(counts, [col], {"_below": F.col("_n")})


def quantiles(df: DataFrame, col: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, as percentile gives them; only the values beside each place reach the driver."""
    ranked = counted(df.where(~F.isnan(F.col(col).cast("double"))), col)
    ranked = settled(ranked)
    total = ranked.agg(F.sum("_n")).first()[0]
    if not total:
        return [None] * len(shares)
    places = [s * (total - 1) for s in shares]
    wanted = sorted({int(p) for p in places} | {min(int(p) + 1, total - 1) for p in places})
    hit = F.filter(F.array(*[F.lit(x) for x in wanted]), lambda x: (x >= F.col("_below")) & (x < F.col("_below") + F.col("_n")))
    got = {r["at"]: float(r["v"]) for r in ranked.select(F.col(col).cast("double").alias("v"), F.explode(hit).alias("at")).collect()}
    return [got[int(p)] + (p - int(p)) * (got[min(int(p) + 1, total - 1)] - got[int(p)]) for p in places]


def grouped_quantiles(df: DataFrame, keys: list[str], col: Column, shares: dict[str, float]) -> DataFrame:
    """(keys, one column per name in `shares`): exact quantiles of each group with linear interpolation, as percentile gives them. Values are
    counted and numbered by ranges of (group, value), so no task sees a whole group."""
    counts = df.select(*keys, col.cast("double").alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    ranked = settled(running(counts, [*keys, "_v"], {"_below": F.col("_n")}))
    of = ranked.groupBy(*keys).agg(F.min("_below").alias("_first"), F.sum("_n").alias("_total"))
    both = beside(ranked, of, keys).withColumn("_below", F.col("_below") - F.col("_first"))
    places = {name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in shares.items()}
    here = lambda at: F.max(F.when((at >= F.col("_below")) & (at < F.col("_below") + F.col("_n")), F.col("_v")))
    ends = [here(f(p)).alias(f"_{side}{i}") for i, p in enumerate(places.values()) for side, f in (("low", F.floor), ("high", F.ceil))]
    got = both.groupBy(*keys, "_total").agg(*ends)
    out = []
    for i, (name, p) in enumerate(places.items()):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        out.append(F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(name))
    return got.select(*keys, *out)


def beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys, of which null equals null."""
    named = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    on = [left[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)]
    return (left.join(named, on, "left") if keys else left.join(named, how="cross")).drop(*[f"_k{i}" for i in range(len(keys))])
