"""Nulls, ties, repeated rows and empty tables in the cleaning, resolution, counting, event and quality operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvia.operators import agg, events, quality, resolve, tidy


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_codes_and_groups(spark):
    df = table(spark, "c string, n long", ("a", 1), ("A ", 2), (None, 3), ("z", 4), ("a", 1))
    variants = table(spark, "variant string, canonical string", ("A ", "a"), ("A ", "b"), (None, "q"))
    assert rows_of(tidy.unify_codes(df, "c", variants)) == rows_of(table(spark, "c string, n long", ("a", 1), ("a", 2), (None, 3), ("z", 4), ("a", 1)))
    dim = table(spark, "c string, g string", ("a", "x"), ("a", "x"), (None, "y"))
    assert rows_of(tidy.derive_group(df, "c", dim, "g").select("c", "g")) == rows_of(table(spark, "c string, g string", ("a", "x"), ("A ", None), (None, None), ("z", None), ("a", "x")))
    with pytest.raises(Exception, match="several groups"):
        tidy.derive_group(df, "c", table(spark, "c string, g string", ("a", "x"), ("a", "y")), "g").collect()
    assert rows_of(tidy.exclude_group(df, "c", "a").select("n")) == [(2,), (3,), (4,)]
    assert tidy.unify_codes(df.limit(0), "c", variants).count() == 0


def test_blanks_bounds_and_bins(spark):
    df = table(spark, "a string, b string", (" ", ""), ("x", None), (None, None), (" y ", " "))
    assert rows_of(tidy.drop_all_blank(df, ["a", "b"])) == rows_of(table(spark, "a string, b string", ("x", None), ("y", " ")))
    assert rows_of(tidy.presence_flags(df, ["a"]).select("a", "has_a")) == rows_of(table(spark, "a string, f boolean", (" ", False), ("x", True), ("", False), (" y ", True)))
    where = table(spark, "lat double, lon double", (1.0, 1.0), (2.0, 1.0), (None, 1.0), (float("nan"), 1.0))
    assert [r["in_box"] for r in tidy.in_bounds(where, "lat", "lon", (0.0, 1.0, 1.0, 2.0)).collect()] == [True, False, False, False]
    x = table(spark, "k long, x double", *[(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 2.0, None, 9.0])])
    assert [r["bin"] for r in tidy.qcut(x, "x", 2).orderBy("k").collect()] == [0, 0, 0, 1, None, 1]
    assert [r["x_z"] for r in tidy.log1p_scale(table(spark, "x double", (3.0,), (3.0,), (None,)), ["x"]).collect()] == [None, None, None]
    sparse = tidy.counts_from_sparse(table(spark, "p long, q long", (None, None), (1, None), (1, 3)), ["p", "q"], "p")
    assert [(r["total"], r["share"]) for r in sparse.collect()] == [(0, None), (1, 1.0), (4, 0.25)]


def test_resolution(spark):
    df = table(spark, "k string, n long", ("a", 1), (None, 2), ("b", 3), ("a", 1))
    dim = table(spark, "k string, v long", ("a", 7), (None, 8))
    assert rows_of(resolve.join_left(df, dim, "k")) == rows_of(table(spark, "k string, n long, v long", ("a", 1, 7), ("a", 1, 7), ("b", 3, None), (None, 2, None)))
    assert rows_of(resolve.semi_join(df, dim, "k").select("n")) == [(1,), (1,)] and rows_of(resolve.anti_join(df, dim, "k").select("n")) == [(2,), (3,)]
    with pytest.raises(ValueError):
        resolve.assert_unique(df, ["k"])
    assert resolve.assert_unique(dim, ["k"]).count() == 2 and resolve.repeated_keys(df.limit(0), ["k"]).count() == 0
    catalog = table(spark, "name string, id long", ("Centro", 1), ("centro", 2), ("Norte", 3), (None, 4), ("Norte", 3))
    sure = resolve.unambiguous_catalog(catalog, "name", "id")
    assert [tuple(r) for r in sure.where("name = 'Norte'").select("name", "id").collect()] == [("Norte", 3)]
    names = table(spark, "c string", ("Norte",), ("norte",), (None,), ("",), ("Nortes",))
    got = {r["c"]: r["id"] for r in resolve.resolve_fuzzy(names, "c", catalog, "name", "id").collect()}
    assert got == {"Norte": 3, "norte": 3, None: None, "": None, "Nortes": 3}
    assert resolve.resolve_fuzzy(names.limit(0), "c", catalog, "name", "id").count() == 0 and resolve.resolve_fuzzy(names, "c", catalog.limit(0), "name", "id").where("id is not null").count() == 0


def test_counts(spark):
    df = table(spark, "k string, v long", ("a", 2), ("a", 1), ("a", None), (None, 5), ("b", None), ("a", 2), ("a", 1))
    assert rows_of(agg.count_by(df, ["k"])) == rows_of(table(spark, "k string, n long", ("a", 5), ("b", 1), (None, 1)))
    assert rows_of(agg.mode_per_group(df, "k", "v")) == rows_of(table(spark, "k string, v long, n long", ("a", 1, 2), (None, 5, 1)))  # ties: the smallest
    assert agg.duplicate_count(df).first()[0] == 2 and agg.duplicate_count(df.limit(0)).first()[0] == 0
    assert rows_of(agg.dedupe_first(df, ["k"], ["v"])) == rows_of(table(spark, "k string, v long", ("a", None), ("b", None), (None, 5)))  # null first
    top = agg.top_k_per_group(df.withColumn("t", F.monotonically_increasing_id()), "k", "v", "t", 1)
    assert sorted(r["v"] for r in top.collect() if r["v"] is not None) == [2, 5]
    assert rows_of(agg.head_per_group(df, "k", "v", 1)) == rows_of(table(spark, "k string, e array<long>", ("a", [1]), (None, [5])))
    assert rows_of(agg.except_keys(df, df.where("k = 'a'"), ["k"])) == [("b",), (None,)]
    days = table(spark, "k string, d timestamp", ("a", dt.datetime(2024, 1, 1, 5)), ("a", dt.datetime(2024, 1, 1, 9)), ("a", dt.datetime(2024, 1, 5)), ("a", None), (None, dt.datetime(2024, 1, 1)))
    assert rows_of(agg.gap_days(days, "d", 3, ["k"]).select("k", "days")) == [("a", 4)]
    assert agg.missing_periods(days.limit(0), "d").count() == 0
    shares = agg.share_of_flag(table(spark, "k string, f boolean", ("a", True), ("a", None), (None, False)), "k", F.col("f"))
    assert rows_of(shares.select("k", "percent")) == [("a", 50.0), (None, 0.0)]


def test_events(spark):
    day = lambda i: dt.date(2024, 7, 1) + dt.timedelta(days=i)
    rain = table(spark, "date date, mm double", *[(day(i), mm) for i, mm in enumerate([0.0, 25.0, None, 0.0, 0.0, 0.0])])
    got = [(r["date"], r["recent_max_mm"]) for r in events.response_window(rain).orderBy("date").collect()]
    assert len(got) == 6 and max(m for _, m in got if m is not None) == 25.0
    study = table(spark, "s string, month int, recent_max_mm double, n double", ("a", 7, 20.0, 4.0), ("a", 7, 0.0, 0.0), ("a", 7, None, 9.0), ("a", 7, 0.0, None), ("b", 1, 20.0, 5.0))
    assert rows_of(events.event_study(study, "s")) == [("a", 1, 4.0, 1, 0.0, None)]  # a dry mean of 0 gives no ratio
    assert events.event_study(study.limit(0), "s").count() == 0
    one_sided = table(spark, "s string, year_month date, recent_max_mm double, n double", ("a", day(0), 20.0, 4.0), ("b", day(0), 0.0, 4.0))
    assert events.within_month_ratio(one_sided, "s").count() == 0 and events.within_month_interval(one_sided, "s").count() == 0
    ranks = table(spark, "k long, x double", (1, 5.0), (2, 5.0), (3, None), (4, 1.0))
    assert [r["rank"] for r in events.average_rank(ranks, "x").orderBy("k").collect()] == [2.5, 2.5, None, 1.0]
    flat = events.spearman(table(spark, "a double, b double", (1.0, 2.0), (1.0, 3.0)), "a", "b").first()
    assert None in tuple(flat) or any(v != v for v in flat if isinstance(v, float))  # no spread, no correlation


def test_quality(spark):
    df = table(spark, "k long, v long", (1, 5), (1, None), (None, 50), (2, -1))
    report = quality.validate(df, [quality.in_range("v", 0, 10), quality.not_null("k")])
    assert report.count() > 0 and quality.validate(df.limit(0), [quality.in_range("v", 0, 10), quality.not_null("k")]).count() == 0
    missing = {r["column"]: r for r in quality.missing_table(df).collect()}
    assert set(missing) <= {"k", "v"}
    assert {r["column"]: r["n_distinct"] for r in quality.column_profile(df.unionByName(df)).collect()} == {"k": 2, "v": 3}
