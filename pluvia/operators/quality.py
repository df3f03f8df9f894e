"""Rules, profiles, missingness and lineage: one pass per table wherever the question allows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.operators.ranks import quantiles
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, NumericType, StringType, StructType, TimestampType


@dataclass(frozen=True)
class Rule:
    """A named rule: `ok` is null or true for rows that keep it. `unique` rules name key columns instead."""

    column: str
    name: str
    ok: Column | None = None
    unique: tuple[str, ...] = ()


def not_null(col: str) -> Rule:
    return Rule(col, "not_null", F.col(col).isNotNull())


def unique(*cols: str) -> Rule:
    return Rule("+".join(cols), "unique", unique=cols)


def in_range(col: str, low=None, high=None) -> Rule:
    ok = F.lit(True)
    ok = ok & (F.col(col) >= low) if low is not None else ok
    return Rule(col, f"in_range({low}, {high})", ok & (F.col(col) <= high) if high is not None else ok)


def in_set(col: str, values: list) -> Rule:
    return Rule(col, "in_set", F.col(col).isin(values))


def full_match(col: str, pattern: str) -> Rule:
    return Rule(col, f"full_match({pattern})", F.col(col).rlike(f"^(?:{pattern})$"))


def length_between(col: str, low: int, high: int) -> Rule:
    return Rule(col, f"length({low}, {high})", F.length(col).between(low, high))


def predicate(name: str, ok: Column, column: str = "*") -> Rule:
    return Rule(column, name, ok)


def validate(df: DataFrame, rules: list[Rule], examples: int = 5) -> DataFrame:
    """column, rule, failing, examples (up to five smallest distinct values, as text): one row per broken rule.

    All row rules are counted in one aggregate, examples included (a bounded top list per task); uniqueness takes one
    grouping per key. A rule that is null on a row counts as kept, except not_null.
    """
    row_rules = [(i, r) for i, r in enumerate(rules) if r.ok is not None]
    parts = []
    if row_rules:
        shown = lambda r: (F.col(r.column) if r.column in df.columns else F.to_json(F.struct("*"))).cast("string")
        tests = df.select(*[F.when(~F.coalesce(r.ok, F.lit(r.name != "not_null")), F.struct(F.coalesce(shown(r), F.lit("null")).alias("v"))).alias(f"f{i}") for i, r in row_rules])
        # distinct examples per rule: smallest values by repeated minimum would rescan, a stack groups once instead
        long = tests.select(F.explode(F.array_compact(F.array(*[F.when(F.col(f"f{i}").isNotNull(), F.struct(F.lit(i).alias("i"), F.col(f"f{i}.v").alias("v"))) for i, _ in row_rules]))).alias("x")).select("x.*")
        values = long.groupBy("i", "v").agg(F.count("*").alias("c"))
        parts.append(_report(values, examples))
    for i, r in enumerate(rules):
        if r.unique:
            sizes = df.groupBy(*r.unique).agg(F.count("*").alias("c")).where("c > 1")
            value = F.col(r.unique[0]).cast("string") if len(r.unique) == 1 else F.concat_ws("|", *[F.col(c).cast("string") for c in r.unique])
            parts.append(_report(sizes.select(F.lit(i).alias("i"), F.coalesce(value, F.lit("null")).alias("v"), "c"), examples))
    found = reduce(DataFrame.unionByName, parts)
    names = df.sparkSession.createDataFrame([(i, r.column, r.name) for i, r in enumerate(rules)], "i int, column string, rule string")
    return found.join(F.broadcast(names), "i").select("column", "rule", "failing", "examples")


def _report(values: DataFrame, examples: int) -> DataFrame:
    """Counts per rule and the first values: the window keeps `examples` rows per rule and task before the shuffle."""
    from pyspark.sql import Window

    first = values.withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy("v"))).where(F.col("r") <= examples)
    lists = first.groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("examples"))
    return values.groupBy("i").agg(F.sum("c").alias("failing")).join(lists, "i")


def validate_all(tables: dict[str, DataFrame | None], rules: dict[str, list[Rule]]) -> DataFrame:
    """Reports of all tables with rules, one column more for the name. A missing table is an error, named with the others;
    tables without rules are skipped."""
    missing = sorted(n for n in rules if tables.get(n) is None)
    if missing:
        raise ValueError(f"missing tables: {missing}")
    return reduce(DataFrame.unionByName, [validate(tables[n], r).withColumn("table", F.lit(n)) for n, r in rules.items()])


def require_valid(report: DataFrame) -> None:
    """Raises naming every broken table, if the report has a row."""
    if broken := [r[0] for r in report.select("table").distinct().orderBy("table").collect()]:
        raise ValueError(f"broken: {broken}")


def _as_text(c: Column, kind: DataType) -> Column:
    """A text that two values share if and only if they are equal."""
    if isinstance(kind, (FloatType, DoubleType)):
        return (c + F.lit(0.0)).cast("string")  # -0.0 equals 0.0
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("string")  # texts of instants repeat where clocks go back
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if isinstance(kind, (ArrayType, StructType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """(i, n): distinct values of the i-th column that aren't null. Rows become narrow (column, value) pairs, which are summed up in each task before
    they are dealt by both, so no row is copied whole and one common value doesn't gather."""
    values = F.array(*[F.struct(F.lit(i).alias("i"), _as_text(F.col(f"`{f.name}`"), f.dataType).alias("v")) for i, f in enumerate(df.schema.fields)])
    return df.select(F.inline(values)).where("v is not null").groupBy("i", "v").agg(F.lit(1).alias("one")).groupBy("i").agg(F.count("*").alias("n"))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, null percentage, exact distinct values, min and max (hidden for text)."""
    flat = [(f.name, f.dataType) for f in df.schema.fields]
    ordered = lambda t: not isinstance(t, (StringType, MapType))
    aggs = [F.count("*").alias("_n")]
    for i, (c, t) in enumerate(flat):
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"c{i}"))
        aggs += [F.min(f"`{c}`").cast("string").alias(f"a{i}"), F.max(f"`{c}`").cast("string").alias(f"b{i}")] if ordered(t) else []
    hidden = F.lit(None).cast("string")
    rows = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.lit(t.simpleString()).alias("type"), (100.0 * F.try_divide(F.col("_n") - F.col(f"c{i}"), F.col("_n"))).alias("null_percent"),
                 (F.col(f"a{i}") if ordered(t) else hidden).alias("min"), (F.col(f"b{i}") if ordered(t) else hidden).alias("max"))
        for i, (c, t) in enumerate(flat)
    ])
    known = df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")
    return known.join(F.broadcast(distinct_counts(df)), "i", "left").select("column", "type", "null_percent", F.coalesce("n", F.lit(0)).cast("long").alias("n_distinct"), "min", "max")


def data_dictionary(df: DataFrame, descriptions: dict[str, str], grain: str) -> DataFrame:
    """Profile with descriptions and the row grain; raises for columns without description and descriptions without column."""
    lost, gone = sorted(set(df.columns) - set(descriptions)), sorted(set(descriptions) - set(df.columns))
    if lost or gone:
        raise ValueError(f"not described: {lost}; no such column: {gone}")
    text = df.sparkSession.createDataFrame(list(descriptions.items()), "column string, description string")
    note = F.when(F.col("type") == "string", "range withheld")
    return column_profile(df).join(F.broadcast(text), "column").withColumn("grain", F.lit(grain)).withColumn("note", note)


def missing_table(df: DataFrame) -> DataFrame:
    """Nulls, empty strings and their percentage for columns that have any, most first."""
    fields = df.schema.fields
    blank = lambda f: F.count_if(F.trim(f.name) == "") if isinstance(f.dataType, StringType) else F.lit(0).cast("long")
    sums = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)], *[F.max(F.lit(0).cast("long")).alias(f"e{i}") if not isinstance(f.dataType, StringType) else blank(f).alias(f"e{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("nulls"), F.col(f"e{i}").alias("empty"), (100.0 * F.try_divide(F.col(f"n{i}") + F.col(f"e{i}"), F.col("_n"))).alias("percent")) for i, f in enumerate(fields)])
    return sums.select(F.explode(rows).alias("r")).select("r.*").where("nulls + empty > 0").orderBy(F.desc("percent"), "column")


def table_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, columns with missing, duplicate rows, numeric and text columns."""
    from pyspark.sql.types import NumericType as N

    names, fields = df.columns, df.schema.fields
    sums = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    total = lambda g: reduce(lambda a, b: a + b, [g(F.col(f"n{i}")) for i in range(len(names))])
    repeats = df.groupBy(*names).agg(F.count("*").alias("_c")).agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"))
    return sums.join(repeats, how="cross").select(
        "rows", F.lit(len(names)).cast("long").alias("columns"), total(lambda c: c).alias("missing_cells"), total(lambda c: (c > 0).cast("long")).alias("columns_missing"), "duplicates",
        F.lit(sum(isinstance(f.dataType, N) for f in fields)).cast("long").alias("numeric"), F.lit(sum(isinstance(f.dataType, StringType) for f in fields)).cast("long").alias("text"),
    )


def profile_alerts(df: DataFrame, missing: float = 0.05, zeros: float = 0.1, skew: float = 20.0, top: float = 0.9) -> DataFrame:
    """column, alert: missing, zeros, constant, unique, imbalanced (a text value above `top`), skewed.

    Thresholds are parameters; they are ours. All but the imbalance come from one aggregate.
    """
    fields = df.schema.fields
    numeric = lambda f: isinstance(f.dataType, NumericType)
    aggs = [F.count("*").alias("_n")]
    for i, f in enumerate(fields):
        aggs += [F.count(F.col(f.name)).alias(f"c{i}"), F.count_distinct(F.col(f.name)).alias(f"d{i}")]
        aggs += [F.count_if(F.col(f.name) == 0).alias(f"z{i}"), F.when(F.stddev_pop(f.name) > 0, F.skewness(f.name)).alias(f"s{i}")] if numeric(f) else []
    alerts = []
    for i, f in enumerate(fields):
        n, c, d = F.col("_n"), F.col(f"c{i}"), F.col(f"d{i}")
        tests = {"missing": n - c > missing * n, "constant": d == 1, "unique": (d == n) & (n > 1)}
        if numeric(f):
            tests |= {"zeros": F.col(f"z{i}") > zeros * n, "skewed": F.abs(F.col(f"s{i}")) > skew}
        alerts += [F.when(t, F.struct(F.lit(f.name).alias("column"), F.lit(k).alias("alert"))) for k, t in tests.items()]
    out = df.agg(*aggs).select(F.explode(F.array_compact(F.array(*alerts))).alias("r")).select("r.*")
    text = [f.name for f in fields if isinstance(f.dataType, StringType)]
    if text:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in text])).alias("x")).select("x.*").where("v is not null")
        counts = long.groupBy("column", "v").agg(F.count("*").alias("c")).groupBy("column").agg(F.max("c").alias("m"), F.sum("c").alias("t"), F.count("*").alias("k"))
        out = out.unionByName(counts.where((F.col("k") > 1) & (F.col("m") > top * F.col("t"))).select("column", F.lit("imbalanced").alias("alert")))
    return out


def structural_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, holds (rows that satisfy it; null counts as no), always: all invariants in one pass."""
    sums = df.agg(F.count("*").alias("_n"), *[F.count_if(F.coalesce(p, F.lit(False))).alias(f"r{i}") for i, p in enumerate(rules.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("holds"), (F.col(f"r{i}") == F.col("_n")).alias("always")) for i, n in enumerate(rules)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def missing_by(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """Percentage missing of each column by another column."""
    sums = df.groupBy(by).agg(F.count("*").alias("rows"), *[(100 * F.avg(F.col(c).isNull().cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_percent")) for i, c in enumerate(cols)])
    return sums.select(F.col(by).cast("string").alias("by"), "rows", F.explode(rows).alias("r")).select("by", "rows", "r.*")


def check_export(df: DataFrame, columns: list[str], key: str, lat: str, lon: str, date: str, date_text: str, year: str, box: tuple) -> tuple[DataFrame, DataFrame]:
    """(report, corrected): rule report of an export, and the rows with the year rewritten from the date where they differ.
    Missing columns raise, as nothing else can be checked; an empty table breaks the rule 'rows'."""
    lost = sorted(set(columns) - set(df.columns))
    if lost:
        raise ValueError(f"missing columns: {lost}")
    south, north, west, east = box
    parsed, written = F.col(date).try_cast("date"), F.try_to_date(F.col(date_text), "dd/MM/yyyy")
    rules = [unique(key), in_range(lat, south, north), in_range(lon, west, east), predicate("dates_agree", parsed.isNotNull() & (parsed == written), date)]
    rules += [Rule(c, "not_blank", F.trim(F.col(c).cast("string")) != "") for c in columns] + [not_null(c) for c in columns]
    report = validate(df, rules)
    empty = df.agg(F.count("*").alias("c")).where("c = 0").select(F.lit("*").alias("column"), F.lit("rows").alias("rule"), F.col("c").alias("failing"), F.array(F.lit("empty")).alias("examples"))
    corrected = df.withColumn(year, F.when(parsed.isNotNull(), F.year(parsed)).otherwise(F.col(year)))
    return report.unionByName(empty), corrected


def distribution_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, count, mean, std (sample), min, p50, p75, p90, p95, p99, max. Quantiles come from ranges of each column's values."""
    qs = [0.5, 0.75, 0.9, 0.95, 0.99]
    aggs = []
    for i, c in enumerate(cols):
        x, marks = F.col(c).cast("double"), F.array(*[F.lit(v).cast("double") for v in quantiles(df, c, qs)])
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.when(F.count(x) > 1, F.stddev_samp(x)).alias(f"s{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.first(marks).alias(f"q{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"), F.col(f"a{i}").alias("min"), *[F.col(f"q{i}")[j].alias(f"p{int(q * 100)}") for j, q in enumerate(qs)], F.col(f"b{i}").alias("max")) for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def quality_summary(df: DataFrame, located: Column, in_box: Column, year: Column, date_year: Column, repeat_key: list[Column]) -> DataFrame:
    """rows, located_percent, out_of_box, year_differs, repeated (rows that repeat an earlier place, date and text)."""
    first = df.agg(F.count("*").alias("rows"), (100 * F.avg(located.cast("double"))).alias("located_percent"), F.count_if(~in_box).alias("out_of_box"), F.count_if(year != date_year).alias("year_differs"))
    repeats = df.groupBy(*[c.alias(f"k{i}") for i, c in enumerate(repeat_key)]).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("repeated"))
    return first.join(repeats, how="cross")


def lineage_table(files: DataFrame, sources: dict[str, str]) -> DataFrame:
    """path, length, modified, digest and source note of raw files (see sources.io.file_digests), by file name pattern."""
    note = None
    for pattern, text in sources.items():
        note = (F if note is None else note).when(F.col("path").rlike(pattern), text)
    return files.withColumn("source", note if note is not None else F.lit(None).cast("string"))


def hidden_missing(df: DataFrame, sentinels: dict[str, list], by: str, total: str = "total") -> DataFrame:
    """Counts of sentinel values that stand for missing, by group and in all."""
    counted = df.cube(by).agg(F.grouping(by).alias("_g"), F.count("*").alias("rows"), *[F.count_if(F.col(c).isin(v)).alias(f"hidden_{c}") for c, v in sentinels.items()])
    return counted.withColumn(by, F.when(F.col("_g") == 1, total).otherwise(F.col(by).cast("string"))).drop("_g")


def repeat_mentions(df: DataFrame, post: str, place: str, cols: list[str]) -> DataFrame:
    """rows, identical (rows equal to an earlier one), repeated (rows with an earlier post and place), posts with a repeat, pairs."""
    pairs = df.groupBy(post, place).agg(F.count("*").alias("c"))
    posts = pairs.groupBy(post).agg(F.sum(F.col("c") - 1).alias("r"), F.count("*").alias("p"), F.sum("c").alias("n"))
    sums = posts.agg(F.sum("n").alias("rows"), F.sum("r").alias("repeated"), F.count_if(F.col("r") > 0).alias("posts_with_repeat"), F.sum("p").alias("pairs"))
    same = df.groupBy(*cols).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("identical"))
    return sums.join(same, how="cross")
