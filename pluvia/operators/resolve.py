"""Joins with checks, and resolution of names to catalog ids with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.functions.text import normalize_name, normalize_settlement, similar_pairs


def join_left(df: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    return df.join(dim, on, how)


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def outer_add(a: DataFrame, b: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Sums two keyed counts; a missing side counts 0."""
    both = a.select(key, F.col(n).alias("_a")).join(b.select(key, F.col(n).alias("_b")), key, "full")
    return both.select(key, (F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))).alias(n))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df itself; raises with up to five examples if a key repeats."""
    found = repeated_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"repeated {keys}: {[r.asDict() for r in found]}")
    return df


def join_validated(df: DataFrame, other: DataFrame, on: str, cardinality: str = "m:1", how: str = "left") -> DataFrame:
    """Join that first checks the sides which must be unique: 1:1 or m:1."""
    assert_unique(other, [on])
    if cardinality == "1:1":
        assert_unique(df, [on])
    return df.join(other, on, how)


def unambiguous_catalog(dim: DataFrame, name: str, key: str) -> DataFrame:
    """(name, key) of names that belong to exactly one id."""
    return dim.where(F.col(name).isNotNull()).groupBy(name).agg(F.count_distinct(F.col(key)).alias("_ids"), F.min(key).alias(key)).where("_ids = 1").drop("_ids")


def resolve_by_name(df: DataFrame, col: str, catalog: DataFrame, name: str, key: str) -> DataFrame:
    """Adds the id of the equal normalised name, and its source 'catalogo'."""
    cat = unambiguous_catalog(catalog.select(normalize_name(F.col(name)).alias("_n"), key), "_n", key)
    out = df.withColumn("_n", normalize_name(F.col(col))).join(cat, "_n", "left").drop("_n")
    return out.withColumn(f"{key}_source", F.when(F.col(key).isNotNull(), "catalogo"))


def resolve_by_alias(df: DataFrame, col: str, aliases: DataFrame, alias: str, target: str, catalog: DataFrame, name: str, key: str) -> DataFrame:
    """Fills ids that are still missing from an alias table; source 'equivalencia'. Blank and NA targets are ignored,
    targets outside the catalog never resolve (see unresolved_aliases)."""
    cat = unambiguous_catalog(catalog.select(normalize_name(F.col(name)).alias("_t"), F.col(key).alias("_id")), "_t", "_id")
    good = usable_aliases(aliases, alias, target).join(cat, "_t").select("_n", "_id")
    out = df.withColumn("_n", normalize_name(F.col(col))).join(good, "_n", "left")
    source = F.when(F.col(key).isNotNull(), F.col(f"{key}_source")).when(F.col("_id").isNotNull(), "equivalencia")
    return out.withColumn(f"{key}_source", source).withColumn(key, F.coalesce(key, "_id")).drop("_n", "_id")


def usable_aliases(aliases: DataFrame, alias: str, target: str) -> DataFrame:
    a = aliases.select(normalize_name(F.col(alias)).alias("_n"), normalize_name(F.col(target)).alias("_t"))
    return a.where("_n <> '' and _t not in ('', 'NA')").groupBy("_n").agg(F.min("_t").alias("_t"))


def unresolved_aliases(aliases: DataFrame, alias: str, target: str, catalog: DataFrame, name: str) -> DataFrame:
    return usable_aliases(aliases, alias, target).join(catalog.select(normalize_name(F.col(name)).alias("_t")).distinct(), "_t", "left_anti").select(F.col("_n").alias(alias), F.col("_t").alias(target))


def resolve_fuzzy(names: DataFrame, col: str, catalog: DataFrame, name: str, key: str, threshold: float = 0.88, margin: float = 0.05, mode: str = "ratio") -> DataFrame:
    """(col, key, method, score) per distinct name: exact, else the most similar catalog name. Refused if ambiguous in the
    catalog, under the threshold, or with a runner-up within the margin."""
    distinct = names.select(col).distinct().withColumn("_n", normalize_settlement(F.col(col)))
    cat = catalog.select(normalize_settlement(F.col(name)).alias("_c"), key).where("_c is not null")
    grouped = cat.groupBy("_c").agg(F.count_distinct(F.col(key)).alias("_k"), F.min(key).alias(key))
    sure = grouped.where("_k = 1").drop("_k")
    exact = distinct.join(grouped.withColumnRenamed("_c", "_n"), "_n", "left")
    done = exact.where("_k = 1").select(col, key, F.lit("exact").alias("method"), F.lit(1.0).alias("score"))
    rest = exact.where("_n is not null and _k is null").select(col, "_n")
    pairs = similar_pairs(rest, "_n", sure, "_c", threshold, mode)
    w = Window.partitionBy("_n").orderBy(F.desc("score"), "_c")
    best = pairs.withColumn("_r", F.row_number().over(w)).withColumn("_next", F.lead("score").over(w)).where("_r = 1")
    best = best.where(F.col("_next").isNull() | (F.col("score") - F.col("_next") >= margin)).join(sure, "_c")
    close = rest.join(best, "_n").select(col, key, F.lit("similarity").alias("method"), "score")
    found = done.unionByName(close)
    return distinct.select(col).join(found, col, "left")


def resolve_prefix(df: DataFrame, col: str, catalog: DataFrame, name: str, min_len: int = 5) -> DataFrame:
    """Adds <name>: the longest catalog name that is a prefix of whole words."""
    names = df.select(col).distinct().withColumn("_w", F.split(col, " "))
    prefixes = names.select(col, F.explode(F.expr("transform(sequence(1, size(_w)), n -> array_join(slice(_w, 1, n), ' '))")).alias(name))
    hits = prefixes.where(F.length(name) >= min_len).join(catalog.select(name).distinct(), name)
    best = hits.groupBy(col).agg(F.max_by(name, F.length(name)).alias(name))
    return df.join(best, col, "left")


def explode_lookup_concat(df: DataFrame, key: str, list_col: str, dim: DataFrame, id_col: str, name: str) -> DataFrame:
    """(key, names): a text list of ids as names, in order, without repeats and unknown ids, joined by ', '."""
    items = df.select(key, F.posexplode(F.from_json(list_col, "array<bigint>")).alias("_p", id_col))
    named = items.join(dim.select(id_col, name), id_col)
    joined = named.groupBy(key).agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("_p", name))), lambda s: s[name])), ", ").alias("names"))
    return df.select(key).join(joined, key, "left")


def distinct_list_ids(df: DataFrame, list_col: str) -> DataFrame:
    return df.select(F.explode(F.from_json(list_col, "array<bigint>")).alias("id")).where("id is not null").distinct().orderBy("id")


def coalesce_provenance(df: DataFrame, candidates: list[tuple[str, str]], value: str, source: str) -> DataFrame:
    """First non-null candidate and the label of the one that gave it."""
    label = None
    for col, name in candidates:
        label = (F if label is None else label).when(F.col(col).isNotNull(), name)
    return df.withColumn(value, F.coalesce(*[c for c, _ in candidates])).withColumn(source, label)


def resolve_with_fallback(df: DataFrame, name_col: str, geo_id: str, geo_name: str, catalog: DataFrame, name: str, key: str, final: str = "0") -> DataFrame:
    """Adds key: by name, else the polygon's id if the catalog has it, else by the polygon's name, else `final`."""
    cat = unambiguous_catalog(catalog.select(normalize_name(F.col(name)).alias("_n"), F.col(key).cast("string").alias("_i")), "_n", "_i")
    ids = catalog.select(F.col(key).cast("string").alias("_g")).distinct()
    out = df.withColumn("_a", normalize_name(F.col(name_col))).withColumn("_b", normalize_name(F.col(geo_name)))
    out = out.join(cat.withColumnsRenamed({"_n": "_a", "_i": "_ia"}), "_a", "left").join(ids, F.col(geo_id).cast("string") == F.col("_g"), "left")
    out = out.join(cat.withColumnsRenamed({"_n": "_b", "_i": "_ib"}), "_b", "left")
    return out.withColumn(key, F.coalesce("_ia", "_g", "_ib", F.lit(final))).drop("_a", "_b", "_ia", "_ib", "_g")


def compare_sources(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adds match: whether two names agree after normalising, null if either is missing."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.withColumn("match", F.when(both, normalize_name(F.col(a)) == normalize_name(F.col(b))))


def agreement(df: DataFrame, match: Column) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(match.isNotNull()).alias("comparable"), F.count_if(match).alias("equal"), F.count_if(~match).alias("different")).withColumn("percent", F.try_divide(F.col("equal") * 100.0, F.col("comparable")))


def duplicated_names(df: DataFrame, col: str) -> DataFrame:
    """Rows whose name occurs more than once, with the count."""
    sizes = df.groupBy(col).agg(F.count("*").alias("occurrences")).where("occurrences > 1")
    return df.join(sizes, col)


def sector_lookup(df: DataFrame, list_col: str, macro: str) -> DataFrame:
    """(name, sector) from ';' lists; names under two sectors are left out."""
    names = df.select(F.explode(F.split(list_col, ";")).alias("_x"), F.col(macro)).select(normalize_name(F.col("_x")).alias("name"), macro).where("name <> ''")
    return unambiguous_catalog(names, "name", macro)
