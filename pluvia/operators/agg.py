"""Counts, spines, cross tables, shares and deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.operators.ranks import beside, grouped_quantiles


def date_spine(df: DataFrame, start: Column, end: Column, step: str = "1 day", name: str = "date") -> DataFrame:
    """One row per period from start to end, which are aggregates over df (a literal also is one)."""
    return df.agg(start.alias("_s"), end.alias("_e")).select(
        F.explode(F.sequence("_s", "_e", F.expr(f"interval {step}"))).alias(name)
    )


def daily_counts(df: DataFrame, date: str, start: str, end: str, by: str | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Rows per day (and group) on a dense calendar from start to end; days without rows count 0."""
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(s, e)).alias("date"))
    keys = ["date"] if by is None else ["date", by]
    if by is not None:
        spine = spine.join(groups if groups is not None else df.select(by).distinct(), how="cross")
    inside = df.where(F.col(date).between(s, e))
    counts = inside.groupBy(*[F.col(date).alias("date")], *([by] if by else [])).agg(F.count("*").alias("n"))
    return spine.join(counts, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"))


def resample(df: DataFrame, ts: str, freq: str, aggs: dict[str, Column]) -> DataFrame:
    """Aggregates per period with empty periods present. freq: week (label: its Sunday), month (its first day),
    month_end (its last day), day. Sums and counts of empty periods are 0."""
    start = {
        "day": lambda d: d, "week": lambda d: F.date_sub(F.next_day(d, "MON"), 7),
        "month": lambda d: F.trunc(d, "month"), "month_end": lambda d: F.trunc(d, "month"),
    }[freq](F.to_date(ts))
    label = {"day": lambda p: p, "week": lambda p: F.date_add(p, 6), "month": lambda p: p, "month_end": F.last_day}[freq]
    step = {"day": "1 day", "week": "7 days"}.get(freq, "1 month")
    got = df.where(F.col(ts).isNotNull()).groupBy(start.alias("_p")).agg(*[a.alias(n) for n, a in aggs.items()])
    spine = date_spine(got, F.min("_p"), F.max("_p"), step, "_p")
    return spine.join(got, "_p", "left").select(label(F.col("_p")).alias("period"), *[F.coalesce(n, F.lit(0)).alias(n) for n in aggs])


def count_by(df: DataFrame, keys: list[str], dropna: bool = False) -> DataFrame:
    return (df.dropna(subset=keys) if dropna else df).groupBy(*keys).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Value, count and share of all counted rows. The total is a second small aggregate, not a global window."""
    counts = count_by(df, [col], dropna)
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(total), how="cross").select(col, "n", (F.col("n") / F.col("_t")).alias("share"))


def crosstab(df: DataFrame, row: str, col: str, domain: list, normalize: bool = False) -> DataFrame:
    """Contingency table with one column per value of the domain, counts or shares of the row."""
    out = df.where(F.col(row).isNotNull() & F.col(col).isin(domain)).groupBy(row).pivot(col, domain).agg(F.count(F.lit(1))).fillna(0)
    names = [str(v) for v in domain]
    if not normalize:
        return out
    total = reduce(lambda a, b: a + b, [F.col(f"`{n}`") for n in names])
    return out.select(row, *[F.try_divide(F.col(f"`{n}`"), total).alias(n) for n in names])


def crosstab_margins(df: DataFrame, row: str, col: str, all_label: str = "All") -> DataFrame:
    """Long contingency table with row, column and grand totals."""
    kept = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    cubed = kept.cube(row, col).agg(F.count("*").alias("n"), F.grouping(row).alias("_r"), F.grouping(col).alias("_c"))
    name = lambda c, g: F.when(F.col(g) == 1, F.lit(all_label)).otherwise(F.col(c).cast("string")).alias(c)
    return cubed.select(name(row, "_r"), name(col, "_c"), "n")


def pivot_dense(df: DataFrame, row: str, col: str, domain: list, rows: list | None = None) -> DataFrame:
    """Counts with every column of the domain (and every row, if given) present."""
    out = df.groupBy(row).pivot(col, domain).agg(F.count(F.lit(1)))
    if rows is not None:
        kind = df.schema[row].dataType
        spine = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(r).cast(kind) for r in rows])).alias(row))
        out = spine.join(out, row, "left")
    return out.fillna(0, subset=[str(v) for v in domain])


def named_agg(df: DataFrame, keys: list[str], specs: dict[str, tuple]) -> DataFrame:
    """specs: name -> (column, kind[, argument]); kinds count, nunique, mean, median, min, max, sum, first_by, share, quantile."""
    kinds = {
        "count": lambda c: F.count(c), "mean": lambda c: F.avg(c), "min": lambda c: F.min(c), "max": lambda c: F.max(c), "sum": lambda c: F.sum(c),
        "first_by": lambda c, order: F.min_by(c, order), "share": lambda c: F.avg(c.cast("double")),
    }
    column = lambda c: F.col(c) if isinstance(c, str) else c
    out = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *[kinds[kind](col, *rest).alias(name) for name, (col, kind, *rest) in specs.items() if kind in kinds])
    # sets of values and sorted values aren't held in a group's aggregate: distinct values and their places are rows
    shares: dict[str, dict[str, float]] = {}
    for name, (col, kind, *rest) in specs.items():
        if kind == "nunique":
            out = beside(out, df.select(*keys, column(col).alias("_v")).where("_v is not null").distinct().groupBy(*keys).agg(F.count("*").alias(name)), keys)
            out = out.withColumn(name, F.coalesce(name, F.lit(0)))
        elif kind in ("median", "quantile"):
            shares.setdefault(str(col), {})[name] = rest[0] if rest else 0.5
    for these in shares.values():
        out = beside(out, grouped_quantiles(df, keys, column(specs[next(iter(these))][0]), these), keys)
    return out.select(*keys, *specs)


def monthly_share(df: DataFrame, date: str, years: list[int]) -> DataFrame:
    """Percentage of each month in its year, twelve columns m1 to m12, one decimal."""
    kept = df.select(F.year(date).alias("year"), F.month(date).alias("m")).where(F.col("year").isin(years))
    counts = pivot_dense(kept, "year", "m", list(range(1, 13)))
    total = reduce(lambda a, b: a + b, [F.col(f"`{m}`") for m in range(1, 13)])
    return counts.select("year", *[F.round(F.col(f"`{m}`") / total * 100, 1).alias(f"m{m}") for m in range(1, 13)])


def period_share(df: DataFrame, by: list[str], date: str, months: list[int]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.month(date).isin(months).cast("double")).alias("share"), F.count("*").alias("n"))


def gap_days(df: DataFrame, ts: str, min_gap: int, by: list[str]) -> DataFrame:
    """Consecutive records of a group that are more than min_gap days apart. Days are made distinct first."""
    days = df.where(F.col(ts).isNotNull()).select(*by, F.to_date(ts).alias("until")).distinct()
    before = F.lag("until").over(Window.partitionBy(*by).orderBy("until"))
    gaps = days.withColumn("since", before).withColumn("days", F.datediff("until", "since"))
    return gaps.where(F.col("days") > min_gap).select(*by, "since", "until", "days")


def missing_periods(df: DataFrame, date: str) -> DataFrame:
    """Months without a record between the first and the last record."""
    months = df.where(F.col(date).isNotNull()).select(F.trunc(date, "month").alias("month")).distinct()
    return date_spine(months, F.min("month"), F.max("month"), "1 month", "month").join(months, "month", "left_anti")


def coverage(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, first and last date of each named source."""
    parts = [
        df.agg(F.count("*").alias("rows"), F.min(F.to_date(c)).alias("first"), F.max(F.to_date(c)).alias("last")).select(F.lit(name).alias("source"), "rows", "first", "last")
        for name, (df, c) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier key (all columns by default)."""
    sizes = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("_n"))
    return sizes.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def dedupe_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a stated order. A grouped minimum of the row struct: combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.min(packed).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


def mode_per_group(df: DataFrame, key: str, col: str) -> DataFrame:
    """Most frequent value per key, the smallest on ties; null values don't count."""
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(col).alias("v")))
    return counts.groupBy(key).agg(best.alias("b")).select(key, F.col("b.v").alias(col), (-F.col("b.m")).alias("n"))


def rate_per_area(counts: DataFrame, area: DataFrame, keys: list[str], measure: str = "n", km2: str = "km2") -> DataFrame:
    """Measure per km2 by group; groups without area get null, areas without counts get 0."""
    got = area.join(counts, keys, "left").withColumn(measure, F.coalesce(measure, F.lit(0)))
    return got.withColumn("rate", F.try_divide(F.col(measure), F.col(km2)))


def jaccard_matrix(flags: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise Jaccard index of flag columns, 0 where the union is empty; all pairs in one pass."""
    on = {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in cols}
    pairs = [(a, b) for a in cols for b in cols]
    sums = flags.agg(*[F.count_if(on[a] & on[b]).alias(f"i{k}") for k, (a, b) in enumerate(pairs)], *[F.count_if(on[a] | on[b]).alias(f"u{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.coalesce(F.try_divide(F.col(f"i{k}"), F.col(f"u{k}")), F.lit(0.0)).alias("jaccard")) for k, (a, b) in enumerate(pairs)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def profile_matrix(df: DataFrame, key: str, date: str, min_total: int) -> DataFrame:
    """Shares of the twelve months per key with at least min_total events."""
    counts = pivot_dense(df.where(F.col(key).isNotNull()).select(key, F.month(date).alias("m")), key, "m", list(range(1, 13)))
    total = reduce(lambda a, b: a + b, [F.col(f"`{m}`") for m in range(1, 13)])
    return counts.where(total >= min_total).select(key, *[(F.col(f"`{m}`") / total).alias(f"m{m}") for m in range(1, 13)])


def chain_relabel(df: DataFrame, col: str, labels: dict, measure: str, other: str = "otros") -> DataFrame:
    """Renames categories, the rest to `other`, and sums again."""
    case = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return df.groupBy(F.coalesce(F.try_element_at(case, F.col(col)), F.lit(other)).alias(col)).agg(F.sum(measure).alias(measure))


def mean_by_month(df: DataFrame, date: str) -> DataFrame:
    """Mean count per calendar month over the years present; months without rows are 0."""
    years = df.where(F.col(date).isNotNull()).agg(F.count_distinct(F.year(date)).alias("_y"))
    counts = df.groupBy(F.month(date).alias("month")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    out = spine.join(counts, "month", "left").join(F.broadcast(years), how="cross")
    return out.select("month", F.coalesce(F.try_divide("n", "_y"), F.lit(0.0)).alias("mean_n"))


def share_of_flag(df: DataFrame, by: str, flag: Column) -> DataFrame:
    """Per group: rows with and without the flag, percentage with it, total."""
    f = F.coalesce(flag, F.lit(False))
    got = df.groupBy(by).agg(F.count_if(f).alias("with_flag"), F.count_if(~f).alias("without_flag"), F.count("*").alias("total"))
    return got.withColumn("percent", F.try_divide(F.col("with_flag") * 100.0, F.col("total")))


def never_mentioned(dim: DataFrame, facts: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Members of a dimension without facts, by class: count, without, percentage."""
    seen = facts.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_seen", F.lit(1))
    got = dim.join(seen, key, "left").groupBy(*by).agg(F.count("*").alias("members"), F.count_if(F.col("_seen").isNull()).alias("never"))
    return got.withColumn("percent", F.col("never") * 100.0 / F.col("members"))


def top_k(df: DataFrame, by: list, k: int) -> DataFrame:
    """Largest k rows in an order that should end with a tie-break key; no full sort (takes k per partition)."""
    return df.orderBy(*by).limit(k)


def top_k_per_group(df: DataFrame, group: str, measure: str, tie: str, k: int) -> DataFrame:
    """The measure only for the k largest of each group, null for the others."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc_nulls_last(measure), F.asc(tie)))
    return df.withColumn("_k", rank).withColumn(measure, F.when(F.col("_k") <= k, F.col(measure))).drop("_k")


def sort_stable(df: DataFrame, by: list[str], ties: list[str]) -> DataFrame:
    """Rows in the order of `by`; rows that tie there in the order of `ties`, which should tell all rows apart. Nulls come first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in [*by, *ties]])


def head_per_group(df: DataFrame, key: str, col: str, n: int) -> DataFrame:
    """The n smallest distinct values of each group, as a list. Only n values per group and task are shuffled."""
    w = Window.partitionBy(key).orderBy(col)
    ranked = df.where(F.col(col).isNotNull()).select(key, col).distinct().withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list(col)).alias("examples"))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def except_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).subtract(b.select(*keys))


def intersect_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))
