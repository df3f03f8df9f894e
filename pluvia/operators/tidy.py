"""Typing, cleaning and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.operators.ranks import quantiles

from pluvia.operators.events import cut_right_closed


def unify_codes(df: DataFrame, col: str, variants: DataFrame, variant: str = "variant", canonical: str = "canonical") -> DataFrame:
    """Replaces spelling variants by their canonical value (the smallest, where a variant is listed twice); other values stay."""
    v = variants.groupBy(F.col(variant).alias("_v")).agg(F.min(canonical).alias("_c"))
    out = df.join(v, F.col(col) == F.col("_v"), "left").withColumn(col, F.coalesce("_c", col))
    return out.drop("_v", "_c")


def derive_group(df: DataFrame, code: str, dim: DataFrame, group: str) -> DataFrame:
    """Adds the group of each code; the dimension must give each code one group."""
    one = dim.groupBy(code).agg(F.min(group).alias(group), F.count_distinct(F.col(group)).alias("_n"))
    checked = one.select(code, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("code with several groups: "), F.col(code).cast("string"))).cast("string")).otherwise(F.col(group).cast("string")).alias(group))
    return df.join(checked, code, "left")


def clean_calls(df: DataFrame, code: str, allowed: Sequence, renames: dict[str, str], groups: DataFrame, group: str, ints: Sequence[str] = ()) -> DataFrame:
    """Drops rows with any null, keeps allowed codes, adds the group, renames and casts."""
    kept = df.dropna("any").where(F.col(code).isin(list(allowed)))
    out = derive_group(kept, code, groups, group).withColumnsRenamed(renames)
    return out.withColumns({c: F.col(c).cast("int") for c in ints})


def drop_all_blank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Blank strings become null; rows where all named columns are null go."""
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in cols}).dropna("all", subset=cols)


def project_final(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Fixed output columns (name -> type) in order; absent ones are null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])


def exclude_group(df: DataFrame, col: str, value) -> DataFrame:
    """All rows but those of the value; null rows stay."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def filter_city(df: DataFrame, municipality: str, value: str, locality: str | None = None, locality_value: str | None = None) -> DataFrame:
    out = df.where(F.col(municipality) == value)
    return out.where(F.col(locality) == locality_value) if locality else out


def in_bounds(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Adds in_box: south <= lat <= north and west <= lon <= east; null coordinates are outside."""
    south, north, west, east = box
    inside = F.col(lat).between(south, north) & F.col(lon).between(west, east)
    return df.withColumn("in_box", F.coalesce(inside, F.lit(False)))


def null_outside(df: DataFrame, key: str, valid: DataFrame) -> DataFrame:
    """The key where it is in the valid set, else null; rows stay."""
    v = valid.select(F.col(key).alias("_v")).distinct()
    return df.join(v, F.col(key) == F.col("_v"), "left").withColumn(key, F.col("_v")).drop("_v")


def counts_from_sparse(df: DataFrame, cols: list[str], part: str, total: str = "total", share: str = "share") -> DataFrame:
    """Missing counts are 0; row total; share of `part`, null where the total is 0."""
    out = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in cols})
    out = out.withColumn(total, sum((F.col(c) for c in cols[1:]), F.col(cols[0])))
    return out.withColumn(share, F.try_divide(F.col(part), F.col(total)))


def presence_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds has_<col> and replaces null text by the empty string."""
    flagged = df.withColumns({f"has_{c}": F.coalesce(F.trim(c) != "", F.lit(False)) for c in cols})
    return flagged.withColumns({c: F.coalesce(c, F.lit("")) for c in cols})


def log1p_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds <col>_z: log1p, then standardised by the population deviation; null for constant columns."""
    logs = df.withColumns({f"_l_{c}": F.log1p(F.col(c)) for c in cols})
    stats = logs.agg(*[F.avg(f"_l_{c}").alias(f"_m_{c}") for c in cols], *[F.stddev_pop(f"_l_{c}").alias(f"_s_{c}") for c in cols])
    out = logs.join(F.broadcast(stats), how="cross")  # one row
    return out.select(*df.columns, *[F.try_divide(F.col(f"_l_{c}") - F.col(f"_m_{c}"), F.col(f"_s_{c}")).alias(f"{c}_z") for c in cols])


def cyclic_encode(df: DataFrame, col: str, period: float) -> DataFrame:
    angle = F.col(col) * (2 * 3.141592653589793 / period)
    return df.withColumn(f"{col}_sin", F.sin(angle)).withColumn(f"{col}_cos", F.cos(angle))


def bin_right_closed(df: DataFrame, col: str, edges, labels, name: str = "bin") -> DataFrame:
    return df.withColumn(name, cut_right_closed(F.col(col), edges, labels))


def qcut(df: DataFrame, col: str, q: int, name: str = "bin", by: list[str] | None = None) -> DataFrame:
    """Quantile bins 0..q-1 by linear-interpolation edges, right-closed, the lowest edge included."""
    if not by:
        edges = quantiles(df, col, [i / q for i in range(1, q)])
        over = [F.when(F.col(col) > e, 1).otherwise(0) for e in edges if e is not None]
        return df.withColumn(name, F.when(F.col(col).isNotNull(), sum(over, F.lit(0))))
    cuts = F.array(*[F.lit(i / q) for i in range(q + 1)])
    out = df.join(df.groupBy(*by).agg(F.percentile(F.col(col), cuts).alias("_e")), by)
    above = F.size(F.filter(F.slice("_e", 2, q - 1), lambda e: F.col(col) > e))
    return out.withColumn(name, F.when(F.col(col).isNotNull(), above)).drop("_e")


def exposure_class(df: DataFrame, key: str, exposed: str, events: DataFrame, n: str = "n") -> DataFrame:
    """Adds events (0 if absent) and class: with or without exposure, with or without events."""
    out = df.join(events.select(key, F.col(n).alias("events")), key, "left").withColumn("events", F.coalesce("events", F.lit(0)))
    e, h = F.coalesce(F.col(exposed), F.lit(False)), F.col("events") > 0
    label = F.when(e & h, "con exposición, con eventos").when(e, "con exposición, sin eventos").when(h, "sin exposición, con eventos")
    return out.withColumn("class", label.otherwise("sin exposición, sin eventos"))


