"""Response of event counts to a daily driver series (rain): windows, correlations, wet/dry ratios, bootstrap.

The driver series has one row per day, so windows over it are unpartitioned by design: a century is 36,500 rows.
Event rows are always reduced to counts per day before they meet it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.operators.agg import date_spine
from pluvia.operators.ranks import running
from pluvia.sources.rounds import settled

RAINY_MONTHS = (6, 7, 8, 9, 10)
WET_MM, DRY_MM, RESPONSE_DAYS = 10.0, 1.0, 8
# Right-closed edges and labels of daily rain.
INTENSITY_EDGES = (-0.1, 0.99, 9.99, 19.99, 39.99, 1000.0)
INTENSITY_LABELS = ("seco (<1 mm)", "1 a 10 mm", "10 a 20 mm", "20 a 40 mm", "40 mm o más")


def rolling(df: DataFrame, value: Column, order: str, first: int, last: int, by: list[str] | None = None) -> Column:
    """A window column over rows first..last relative to the current one, in order."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(first, last)
    return value.over(w)


def response_window(rain: DataFrame, date: str = "date", mm: str = "mm", days: int = RESPONSE_DAYS) -> DataFrame:
    """Adds recent_max_mm: largest value of the day and the days-1 rows before it."""
    return rain.withColumn("recent_max_mm", rolling(rain, F.max(mm), date, 1 - days, 0))


def previous_max(rain: DataFrame, date: str = "date", mm: str = "mm", lag: int = 1, days: int = 3) -> DataFrame:
    """Adds previous_max: largest value of the `days` rows that end `lag` rows before; null on the first row."""
    return rain.withColumn("previous_max", rolling(rain, F.max(mm), date, 1 - lag - days, -lag))


def centered_median(df: DataFrame, col: str, order: str, half: int = 14) -> DataFrame:
    """Median of rows -half..+half and the residual from it."""
    med = rolling(df, F.percentile(F.col(col), F.lit(0.5)), order, -half, half)
    return df.withColumn("median", med).withColumn("residual", F.col(col) - F.col("median"))


def daily_spine(rain: DataFrame) -> DataFrame:
    """The driver on every day between its first and last day; missing days have null mm."""
    return date_spine(rain, F.min("date"), F.max("date")).join(rain, "date", "left")


def daily_table(rain: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """One row per day: mm, recent_max_mm, each count series (date, n), month, year_month."""
    out = response_window(rain)
    for name, series in counts.items():
        out = out.join(series.select("date", F.col("n").alias(name)), "date", "left")
    return out.withColumn("month", F.month("date")).withColumn("year_month", F.trunc("date", "month"))


def long_table(rain: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """(date, key, n) series joined to the driver with its window: many studies in one plan."""
    return series.join(F.broadcast(response_window(rain)), "date").withColumn("month", F.month("date")).withColumn("year_month", F.trunc("date", "month"))


def event_study(table: DataFrame, key: str, n: str = "n", wet: float = WET_MM, dry: float = DRY_MM, months=RAINY_MONTHS) -> DataFrame:
    """Per series and in season: wet and dry days, their mean counts, the ratio (null where the dry mean is 0)."""
    kept = table.where(F.col("month").isin(*months) & F.col("recent_max_mm").isNotNull() & F.col(n).isNotNull())
    is_wet, is_dry = F.col("recent_max_mm") >= wet, F.col("recent_max_mm") < dry
    got = kept.groupBy(key).agg(
        F.count_if(is_wet).alias("wet_days"), F.avg(F.when(is_wet, F.col(n))).alias("wet_mean"),
        F.count_if(is_dry).alias("dry_days"), F.avg(F.when(is_dry, F.col(n))).alias("dry_mean"),
    )
    return got.withColumn("ratio", F.try_divide("wet_mean", "dry_mean"))


def within_month_ratio(table: DataFrame, key: str, n: str = "n", wet: float = WET_MM, dry: float = DRY_MM) -> DataFrame:
    """Wet and dry means inside each year-month that has both kinds, and their ratio (null where dry is 0)."""
    kept = table.where(F.col("recent_max_mm").isNotNull() & F.col(n).isNotNull())
    got = kept.groupBy(key, "year_month").agg(
        F.avg(F.when(F.col("recent_max_mm") >= wet, F.col(n))).alias("wet"), F.avg(F.when(F.col("recent_max_mm") < dry, F.col(n))).alias("dry")
    )
    return got.dropna(subset=["wet", "dry"]).withColumn("ratio", F.try_divide("wet", "dry"))


def within_month_interval(table: DataFrame, key: str, n: str = "n", n_boot: int = 2000, lo: float = 5, hi: float = 95, seed: int = 42) -> DataFrame:
    """Ratio of summed wet to summed dry means, with a percentile bootstrap over whole months.

    Each draw of a month is the first 60 bits of md5 of (seed, draw, slot), so draws are independent of each other and of the
    partitions. Only the months' table (one row per series and month) is drawn from: n_boot x months rows, summed at once.
    """
    months = within_month_ratio(table, key, n).select(key, "year_month", "wet", "dry")
    w = Window.partitionBy(key).orderBy("year_month")
    ranked = months.withColumn("slot", F.row_number().over(w) - 1).withColumn("m", F.count("*").over(Window.partitionBy(key)))
    slots = ranked.select(key, "slot", "m").withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))))
    drawn_bits = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), "draw", "slot").cast("binary")), 1, 15), 16, 10).cast("long")
    picked = slots.select(key, "draw", (drawn_bits % F.col("m")).cast("int").alias("slot"))
    drawn = picked.join(ranked.select(key, "slot", "wet", "dry"), [key, "slot"]).groupBy(key, "draw").agg(F.sum("wet").alias("w"), F.sum("dry").alias("d"))
    ratios = drawn.where("d > 0").select(key, (F.col("w") / F.col("d")).alias("r"))
    bounds = ratios.groupBy(key).agg(F.percentile("r", F.lit(lo / 100)).alias("low"), F.percentile("r", F.lit(hi / 100)).alias("high"))
    point = months.groupBy(key).agg(F.count("*").alias("months"), F.try_divide(F.sum("wet"), F.sum("dry")).alias("ratio"))
    return point.join(bounds, key, "left")


def cut_right_closed(value: Column, edges, labels) -> Column:
    """Label of the bin (edge, next edge] that holds the value; null outside."""
    case = F.when((value <= edges[0]) | (value > edges[-1]) | value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels, strict=True):
        case = case.when(value <= edge, F.lit(label))
    return case


def by_intensity(table: DataFrame, n: str = "n", edges=INTENSITY_EDGES, labels=INTENSITY_LABELS, months=RAINY_MONTHS, keys=()) -> DataFrame:
    """Days, mean, 90th percentile and maximum of n per bin of mm in season; bins without days are kept."""
    kept = table.where(F.month("date").isin(*months)).withColumn("intensity", cut_right_closed(F.col("mm"), edges, labels))
    got = kept.where(F.col("intensity").isNotNull()).groupBy(*keys, "intensity").agg(
        F.count("*").alias("days"), F.avg(n).alias("mean"), F.percentile(F.col(n), F.lit(0.9)).alias("bad_day"), F.max(n).alias("most")
    )
    dim = table.sparkSession.createDataFrame([(i, x) for i, x in enumerate(labels)], "ord int, intensity string")
    spine = F.broadcast(dim) if not keys else table.select(*keys).distinct().join(F.broadcast(dim), how="cross")
    return spine.join(got, [*keys, "intensity"], "left").select(*keys, "ord", "intensity", F.coalesce("days", F.lit(0)).alias("days"), "mean", "bad_day", "most")


def event_curve(table: DataFrame, n: str = "n", threshold: float = 20.0, quiet: float = WET_MM, dry: float = DRY_MM, first: int = -3, last: int = 7, months=RAINY_MONTHS) -> DataFrame:
    """Mean count on the days around isolated events (mm at least threshold, less than `quiet` on the 3 days before)."""
    t = previous_max(table)
    events = t.where((F.col("mm") >= threshold) & (F.col("previous_max") < quiet)).select(F.col("date").alias("event"))
    totals = events.agg(F.count("*").alias("events"), F.count_if(F.month("event").isin(*months)).alias("in_season"))
    dry_day = table.where(F.col("mm") < dry).agg(F.avg(n).alias("dry_day"))
    around = events.select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"), F.col("event")).withColumn("date", F.expr("date_add(event, day)"))
    means = around.join(table.select("date", n), "date").groupBy("day").agg(F.avg(n).alias("mean"))
    spine = table.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("day"))
    return spine.join(means, "day", "left").join(F.broadcast(totals), how="cross").join(F.broadcast(dry_day), how="cross")


def extra_by_type(rain: DataFrame, events: DataFrame, kind: str, months=RAINY_MONTHS, wet: float = WET_MM, dry: float = DRY_MM) -> DataFrame:
    """Events per day of each type on days after rain and on dry days, in season, and the difference."""
    days = response_window(rain).where(F.month("date").isin(*months))
    kinds = days.withColumn("k", F.when(F.col("recent_max_mm") >= wet, "wet").when(F.col("recent_max_mm") < dry, "dry"))
    totals = kinds.agg(F.count_if(F.col("k") == "wet").alias("_w"), F.count_if(F.col("k") == "dry").alias("_d"))
    daily = events.groupBy("date", kind).agg(F.count("*").alias("c"))
    got = daily.join(F.broadcast(kinds.where("k is not null").select("date", "k")), "date").groupBy(kind).agg(
        F.sum(F.when(F.col("k") == "wet", F.col("c")).otherwise(0)).alias("w"), F.sum(F.when(F.col("k") == "dry", F.col("c")).otherwise(0)).alias("d")
    )
    out = got.join(F.broadcast(totals), how="cross").select(kind, F.coalesce(F.try_divide("w", "_w"), F.lit(0.0)).alias("after_rain"), F.coalesce(F.try_divide("d", "_d"), F.lit(0.0)).alias("dry_days"))
    return out.withColumn("extra", F.col("after_rain") - F.col("dry_days")).orderBy(F.desc("extra"), kind)


def hour_profile(rain: DataFrame, events: DataFrame, hour: str = "hour", wet: float = WET_MM, dry: float = DRY_MM) -> DataFrame:
    """Percentage of events by hour, on days with rain and on days without for the whole window; 24 rows always."""
    got = events.groupBy("date", hour).agg(F.count("*").alias("c")).join(F.broadcast(response_window(rain)), "date").groupBy(hour).agg(
        F.sum(F.when(F.col("mm") >= wet, F.col("c"))).alias("w"), F.sum(F.when(F.col("recent_max_mm") < dry, F.col("c"))).alias("d")
    )
    total = got.agg(F.sum("w").alias("_w"), F.sum("d").alias("_d"))
    spine = rain.sparkSession.range(24).select(F.col("id").cast("int").alias(hour))
    pct = lambda a, b: F.coalesce(F.try_divide(F.col(a) * 100.0, F.col(b)), F.lit(0.0))
    return spine.join(got, hour, "left").join(F.broadcast(total), how="cross").select(hour, pct("w", "_w").alias("rain_day"), pct("d", "_d").alias("dry_day"))


def seasons_with_events(rain: DataFrame, events: DataFrame, place: str, wet: float = WET_MM) -> DataFrame:
    """Per place: events on days after rain, and in how many years."""
    days = response_window(rain).where(F.col("recent_max_mm") >= wet).select("date")
    hit = events.where(F.col(place).isNotNull()).join(F.broadcast(days), "date", "left_semi")
    return hit.groupBy(place).agg(F.count("*").alias("events"), F.count_distinct(F.year("date")).alias("seasons"))


def dense_series(events: DataFrame, rain: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Daily counts per group on the days of the driver, zeros included: (date, key, n)."""
    spine = rain.select("date").join(groups.select(key).distinct(), how="cross")  # days x groups is what is asked for
    counts = events.groupBy("date", key).agg(F.count("*").alias("n"))
    return spine.join(counts, ["date", key], "left").select("date", key, F.coalesce("n", F.lit(0)).alias("n"))


def series_by_group(events: DataFrame, rain: DataFrame, place: str, place_dim: DataFrame, group: str) -> DataFrame:
    """Dense daily series of each group of places; events without a known place are left out."""
    tagged = events.join(place_dim.select(place, group), place)
    return dense_series(tagged, rain, group, place_dim)


def average_rank(df: DataFrame, col: str, by: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Rank with ties averaged, per group. Counts per distinct value are summed by ranges of (group, value), so neither a column nor a
    group is gathered in one task; a group's own count starts where its smallest value stands. Rows with a null value or group get none."""
    by = by or []
    counts = df.dropna(subset=[*by, col]).groupBy(*by, col).agg(F.count("*").alias("_c"))
    ranked = running(counts, [*by, col], {"_below": F.col("_c")})
    if by:
        ranked = settled(ranked)
        ranked = ranked.join(ranked.groupBy(*by).agg(F.min("_below").alias("_first")), by).withColumn("_below", F.col("_below") - F.col("_first"))
    ranks = ranked.select(*by, col, (F.col("_below") + (F.col("_c") + 1) / 2).alias(name))
    return df.join(ranks, [*by, col], "left")


def spearman(df: DataFrame, a: str, b: str, by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Rank correlation of the rows that have both values, per group; null for constant columns. One row per group:
    n, rho. Rows are counted per pair of values first, so ranks and sums follow the distinct pairs. weight: a column with how
    many rows a row stands for."""
    by = by or []
    both = df.dropna(subset=[a, b]).groupBy(*by, F.col(a).alias("_a"), F.col(b).alias("_b")).agg((F.sum(weight) if weight else F.count("*")).alias("_w"))
    both = settled(both)
    ranked = both
    for c in ("_a", "_b"):
        counts = both.dropna(subset=by).groupBy(*by, c).agg(F.sum("_w").alias("_c"))
        counts = settled(running(counts, [*by, c], {"_below": F.col("_c")}))
        if by:
            counts = counts.join(counts.groupBy(*by).agg(F.min("_below").alias("_first")), by).withColumn("_below", F.col("_below") - F.col("_first"))
        ranked = ranked.join(counts.select(*by, c, (F.col("_below") + (F.col("_c") + 1) / 2).alias("_r" + c)), [*by, c], "left")
    x, y, w = F.col("_r_a"), F.col("_r_b"), F.col("_w")
    sums = ranked.groupBy(*by).agg(
        F.sum(w).alias("n"), *[F.sum(w * v).alias(f"_s{i}") for i, v in enumerate((x, y, x * x, y * y, x * y))], ((F.min(x) < F.max(x)) & (F.min(y) < F.max(y))).alias("_vary")
    )
    mx, my, xx, yy, xy = (F.col(f"_s{i}") / F.col("n") for i in range(5))
    rho = F.when(F.col("_vary"), F.try_divide(xy - mx * my, F.sqrt((xx - mx * mx) * (yy - my * my))))
    return sums.select(*by, F.coalesce("n", F.lit(0)).cast("long").alias("n"), rho.alias("rho"))


def _corr(a: str, b: str) -> Column:
    """Pearson correlation that is null instead of an error for constant columns."""
    cov = F.avg(F.col(a) * F.col(b)) - F.avg(a) * F.avg(b)
    return F.try_divide(cov, F.stddev_pop(a) * F.stddev_pop(b))


def spearman_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """rho of every pair (upper triangle), each on its own complete rows: pairs are stacked and ranked together. Equal rows are
    stacked once, with their number."""
    df = settled(df.groupBy(*cols).agg(F.count("*").alias("_rows")))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    stacked = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a, b in pairs])
    return spearman(df.select(F.explode(stacked).alias("r"), "_rows").select("r.*", "_rows"), "x", "y", ["a", "b"], "_rows")


def lagged_spearman(table: DataFrame, x: str, y: str, lags: list[int], order: str = "date") -> DataFrame:
    """rho of x at row t with y at row t + lag, nulls dropped first, all lags in one pass."""
    kept = table.dropna(subset=[x, y])
    w = Window.orderBy(order)
    led = F.array(*[F.struct(F.lit(k).alias("lag"), F.lead(y, k).over(w).cast("double").alias("y")) for k in lags])
    pairs = kept.select(F.col(x).cast("double").alias("x"), led.alias("led")).select("x", F.explode("led").alias("r"))
    return spearman(pairs.select("x", "r.*"), "x", "y", ["lag"])


def persistence(events: DataFrame, place: str, year_pairs: list[tuple[int, int]]) -> DataFrame:
    """rho of the places' counts between pairs of years; a place absent in a year counts 0."""
    counts = events.where(F.col(place).isNotNull()).groupBy(place, F.year("date").alias("y")).agg(F.count("*").alias("c"))
    years = sorted({y for p in year_pairs for y in p})
    wide = counts.groupBy(place).pivot("y", years).agg(F.sum("c")).fillna(0)
    stacked = F.array(*[F.struct(F.lit(a).alias("y1"), F.lit(b).alias("y2"), F.col(f"`{a}`").cast("double").alias("x"), F.col(f"`{b}`").cast("double").alias("z")) for a, b in year_pairs])
    return spearman(wide.select(F.explode(stacked).alias("r")).select("r.*"), "x", "z", ["y1", "y2"])


def upper_fence_by_group(df: DataFrame, group: str, col: str, k: float = 1.5) -> DataFrame:
    """Adds fence (Q3 + k IQR of the group) and outlier."""
    q = df.groupBy(group).agg(F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    fence = (F.col("_q")[1] + k * (F.col("_q")[1] - F.col("_q")[0])).alias("fence")
    return df.join(q.select(group, fence), group).withColumn("outlier", F.col(col) > F.col("fence"))


def annual_compare(a: DataFrame, b: DataFrame, value_a: str, value_b: str) -> DataFrame:
    """Yearly sums of two dated series side by side, years of both."""
    sums = lambda df, c, name: df.groupBy(F.year("date").alias("year")).agg(F.sum(c).alias(name))
    return sums(a, value_a, "a").join(sums(b, value_b, "b"), "year")


def center_of_group(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Adds each column's group mean as <col>_center."""
    means = df.groupBy(key).agg(*[F.avg(c).alias(f"{c}_center") for c in cols])
    return df.join(means, key)


def intensity_by_group(rain: DataFrame, events: DataFrame, place: str, place_dim: DataFrame, group: str, area: DataFrame) -> DataFrame:
    """Mean daily count per intensity bin and group, per 100 km2."""
    table = series_by_group(events, rain, place, place_dim, group).join(rain, "date")
    got = by_intensity(table, keys=(group,)).join(area, group, "left")
    return got.select(group, "ord", "intensity", "days", (F.try_divide(F.col("mean"), F.col("km2")) * 100).alias("per_100_km2"))


def response_by_group(rain: DataFrame, events: DataFrame, place: str, place_dim: DataFrame, group: str, kinds: list, kind: str, n_boot: int = 2000) -> DataFrame:
    """Per group, for chosen kinds of events: season ratio, within-month ratio with its interval, total events."""
    chosen = events.where(F.col(kind).isin(kinds))
    table = long_table(rain, series_by_group(chosen, rain, place, place_dim, group), group)
    total = table.groupBy(group).agg(F.sum("n").alias("events"))
    season = event_study(table, group).select(group, F.col("ratio").alias("season_ratio"))
    inside = within_month_interval(table, group, n_boot=n_boot).select(group, F.col("ratio").alias("month_ratio"), "low", "high")
    return total.join(season, group, "left").join(inside, group, "left")
