"""Operators on small tables: nulls, empty tables, ties, repeated rows, clashing names, and what random or iterative ones must keep."""

import difflib
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pluvia.functions import text as tx
from pluvia.operators import agg, cluster, events, geo, kd, quality, ranks, resolve, stats, tidy
from pluvia.sources import io


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def points(spark, rows, key="id"):
    return geo.segments(frame(spark, rows, f"{key} long, x double, y double"), key)


def near_by_loops(a, b, k, limit=math.inf):
    out = []
    for i, x, y in a:
        if x is None or y is None or not math.isfinite(x) or not math.isfinite(y):
            continue
        found = sorted((math.hypot(x - u, y - v), j) for j, u, v in b)[:k]
        out += [(i, j, round(d, 6), r + 1) for r, (d, j) in enumerate(found) if d <= limit]
    return sorted(out)


def test_nearest_has_no_cap_and_keeps_what_is_found(spark):
    rnd = random.Random(1)
    a = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(40)] + [(90, 4e7, -3e7), (91, None, 1.0), (92, math.nan, 0.0)]
    b = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(30)] + [(77, 5.0, 5.0), (78, 5.0, 5.0)]
    left, right = points(spark, a), points(spark, b, "other")
    got = lambda df: sorted((r["id"], r["other"], round(r["d"], 6), r["r"]) for r in df.collect())
    assert got(geo.nearest(left, "id", right, "other", 3)) == near_by_loops(a, b, 3)
    assert got(geo.nearest(left, "id", right, "other", 5, limit=12.0)) == near_by_loops(a, b, 5, 12.0)
    assert got(geo.nearest(left, "id", right, "other", 50)) == near_by_loops(a, b, 32)
    assert geo.nearest(left, "id", right.limit(0), "other").count() == 0 and geo.nearest(left.limit(0), "id", right, "other").count() == 0
    wide = {r["id"]: r.asDict() for r in geo.knn_lines(left, "id", right, "other", 2, (1.0, 10.0)).collect()}
    assert wide[90]["id_seg_1"] is None and {k: v["id_seg_1"] for k, v in wide.items()} == {i: {(p, q): o for p, o, _, q in near_by_loops(a, b, 2, 10.0)}.get((i, 1)) for i in wide}


def test_nearest_of_lines_polygons_copies_and_features_far_off(spark, monkeypatch):
    monkeypatch.setattr(kd, "PART_ROWS", 4)
    rnd = random.Random(8)
    names = "ax double, ay double, bx double, by double"
    walk = lambda i, n: [(i, *(c for _ in range(2) for c in (rnd.uniform(0, 500), rnd.uniform(0, 500)))) for _ in range(n)]
    left = [r for i in range(12) for r in walk(i, rnd.choice([1, 3]))]
    right = [r for i in range(30) for r in walk(100 + i, rnd.choice([1, 2, 9]))] + [(900 + i, 250.0, 250.0, 250.0, 250.0) for i in range(50)] + [(1, 1e6, 1e6, 1e6, 1e6)]
    one, two = frame(spark, left, f"id long, {names}"), frame(spark, right, f"other long, {names}")
    every = one.join(two.withColumnsRenamed({c: "o" + c for c in ("ax", "ay", "bx", "by")}), how="cross").withColumn("d", geo.segment_distance())
    each = every.groupBy("id", "other").agg(F.min("d").alias("d")).toPandas().sort_values(["id", "d", "other"])
    for k in (1, 4, 60, 500):
        got = geo.nearest(one, "id", two, "other", k).toPandas().sort_values(["id", "r"])
        want = each.groupby("id").head(k)
        assert got[["id", "other"]].values.tolist() == want[["id", "other"]].values.tolist() and got["d"].tolist() == pytest.approx(want["d"].tolist())


def test_parts_met_do_not_grow_with_one_feature_far_off():
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 7000, (20000, 2))

    def met(right):
        parts = kd.Parts(right[::5], 9)
        at = parts.of(right)
        rows = [(p, *right[at == p].min(axis=0), *right[at == p].max(axis=0), int((at == p).sum())) for p in np.unique(at)]
        parts.boxed(rows, 2)
        ask = rng.uniform(0, 7000, (500, 2))
        row, part = kd.sent(parts, ask, ask, 3, math.inf)
        assert len(row) == 500
        near = np.array([np.sort(np.hypot(*(right[at == p] - a).T))[2] for a, p in zip(ask, part, strict=True)])
        return len(kd.sent(parts, ask, ask, 3, math.inf, near)[0]) / 500

    assert met(np.r_[x, [[1e6, 1e6]]]) < 1.2 * met(x) + 0.2 and met(x) < 6


def test_pairs_of_segments_in_all_directions(spark):
    rnd = random.Random(2)
    segs = lambda n, k: [(i, *(rnd.uniform(0, 400) for _ in range(2)), *(rnd.uniform(0, 400) for _ in range(2))) for i in range(n)] + [(90 + k, 7.0, 7.0, 7.0, 7.0)]
    a, b = segs(25, 0), segs(20, 1)
    names = "ax double, ay double, bx double, by double"
    one, two = frame(spark, a, f"id long, {names}"), frame(spark, b, f"other long, {names}")
    every = one.join(two.withColumnsRenamed({c: "o" + c for c in ("ax", "ay", "bx", "by")}), how="cross").withColumn("d", geo.segment_distance())
    for d in (0.5, 10.0, 90.0):
        want = sorted((r["id"], r["other"], round(r["d"], 9)) for r in every.where(F.col("d") <= d).collect())
        assert sorted((r["id"], r["other"], round(r["d"], 9)) for r in geo.within_distance(one, "id", two, "other", d).collect()) == want
    one_long = frame(spark, [(1, 0.0, 0.0, 6000.0, 6000.0)], f"id long, {names}")
    cells = one_long.select(F.size(geo._along(*[F.col(c) for c in ("ax", "ay", "bx", "by")], 10.0, 50.0)).alias("n")).first()["n"]
    assert cells < 1500  # its box has 14,400


def test_crossings_of_named_streets(spark):
    line = lambda x0, y0, x1, y1: [{"x": x0, "y": y0}, {"x": x1, "y": y1}]
    schema = "street string, points array<struct<x:double,y:double>>"
    streets = frame(spark, [("GENERAL MARIANO ESCOBEDO", line(0.0, 0.0, 200.0, 0.0)), ("ROSALES", line(50.0, -50.0, 50.0, 50.0)), ("2", line(120.0, -50.0, 120.0, 50.0)), ("SEPARADA", line(160.0, -50.0, 160.0, -30.0)), ("LEJANA", line(0.0, 5000.0, 200.0, 5000.0))], schema)
    texts = ["Rosales y Escobedo", "Escobedo entre Rosales y Dos", "Separada y Escobedo", "Lejana y Escobedo", "Rosalez y Escobedo", "Nada y Escobedo", None]
    got = {(r["e"], r["cross"]): (round(r["x"], 3), round(r["y"], 3), round(r["gap"], 3)) for r in geo.locate_expressions(frame(spark, [(x,) for x in texts + texts[:1]], "e string"), "e", streets, "street").collect()}
    assert got == {
        ("Rosales y Escobedo", "Escobedo"): (50, 0, 0), ("Escobedo entre Rosales y Dos", "Rosales"): (50, 0, 0), ("Escobedo entre Rosales y Dos", "Dos"): (120, 0, 0),
        ("Separada y Escobedo", "Escobedo"): (160, -15, 30), ("Rosalez y Escobedo", "Escobedo"): (50, 0, 0),
    }


def test_neighbours_on_a_grid_have_no_cap(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.uniform(0, 50), rnd.uniform(0, 50)) for i in range(60)] + [(80, 1e9, 1e9), (81, 1.0, 1.0), (82, 1.0, 1.0), (83, None, 1.0), (84, math.inf, 0.0)]
    good = [r for r in rows if r[1] is not None and math.isfinite(r[1])]
    want = []
    for i, x, y in good:
        near = sorted((math.hypot(x - u, y - v), j) for j, u, v in good if j != i)[:4]
        want += [(i, j, r + 1) for r, (_, j) in enumerate(near)]
    df = frame(spark, rows, "id long, x double, y double")
    got = sorted((r["id"], r["other"], r["r"]) for r in stats.neighbours(df, "id", ["x", "y"], 4).collect())
    assert got == sorted(want) and stats.neighbours(df.limit(0), "id", ["x", "y"], 4).count() == 0


def test_ranks_and_quantiles_by_ranges(spark):
    rnd = random.Random(4)
    x = [rnd.choice([None, 1.0, 2.0, 2.5, rnd.uniform(-5, 5)]) for _ in range(400)]
    g = [rnd.choice(["a", "b", "c"]) for _ in x]
    df = frame(spark, list(zip(range(400), g, x, strict=True)), "id long, g string, x double").withColumn("_n", F.lit(0)).withColumn("_below", F.lit("q"))
    full = pd.Series(x, dtype=float)
    assert ranks.quantiles(df, "x", [0, 0.1, 0.5, 0.98, 1]) == pytest.approx(full.quantile([0, 0.1, 0.5, 0.98, 1]).tolist())
    assert ranks.quantiles(df.limit(0), "x", [0.5]) == [None]
    got = {r["id"]: r["rank"] for r in events.average_rank(df, "x").collect()}
    want = full.rank().tolist()
    assert all((got[i] is None) == math.isnan(w) and (math.isnan(w) or got[i] == pytest.approx(w)) for i, w in enumerate(want))
    by = {r["id"]: r["rank"] for r in events.average_rank(df, "x", ["g"]).collect()}
    want = full.groupby(g).rank().tolist()
    assert all(math.isnan(w) or by[i] == pytest.approx(w) for i, w in enumerate(want))
    assert [r["i"] for r in ranks.numbered(df, ["g", "id"], "i").orderBy("g", "id").collect()] == list(range(400))
    cut = {r["id"]: r["bin"] for r in tidy.qcut(df, "x", 4).collect()}
    assert {i: b for i, b in cut.items() if b is not None} == {i: int(b) for i, b in enumerate(pd.qcut(full, 4, labels=False)) if not math.isnan(b)}
    flagged = {r["id"] for r in stats.iqr_outliers(df, "x", 0.2).where("outlier").collect()}
    low, high = full.quantile(0.25), full.quantile(0.75)
    assert flagged == {i for i, v in enumerate(x) if v is not None and not low - 0.2 * (high - low) <= v <= high + 0.2 * (high - low)}
    assert stats.iqr_outliers(df.limit(0), "x").count() == 0 and events.average_rank(df.limit(0), "x").count() == 0
    rho = events.spearman(frame(spark, [(float(i), float(i * i)) for i in range(9)] + [(None, 1.0)], "a double, b double"), "a", "b").first()
    assert rho["n"] == 9 and rho["rho"] == pytest.approx(1)


def test_fuzzy_names_compare_as_close_matches_does(spark):
    rnd = random.Random(5)
    streets = ["".join(rnd.choices("abcde ", k=rnd.randint(4, 14))).strip().upper() or "X" for _ in range(80)]
    streets = sorted({" ".join(s.split()) for s in streets if len(s.replace(" ", "")) > 3})
    names = [s[: k] + rnd.choice("zxw") + s[k + rnd.choice([0, 1]) :] for s in streets for k in (1, len(s) // 2)]
    got = {}
    for r in tx.street_candidates(frame(spark, [(n,) for n in [*names, None, "", names[0]]], "name string"), "name", frame(spark, [(s,) for s in streets], "street string"), "street", 0.8).collect():
        got.setdefault(r["name"], set()).add(r["street"])
    checked = 0
    for n in names:
        key = " ".join(n.split())
        if any(f" {key.split()[0]} " in f" {s} " for s in streets):
            continue  # a prefix is contained, so no similarity is asked
        best = difflib.get_close_matches(key, streets, n=1, cutoff=0.8)
        assert got.get(n, set()) == set(best), (n, best)
        checked += 1
    assert checked > 40


def test_fuzzy_resolution_refuses_close_seconds(spark):
    names = frame(spark, [("San Benitto",), ("Villa Soll",), ("Centro",), ("zzz",), (None,), ("San Benitto",)], "raw string")
    catalog = frame(spark, [("San Benito", 1), ("Villa Sola", 2), ("Villa Sole", 3), ("Centro", 4)], "name string, id int")
    got = {r["raw"]: r["id"] for r in resolve.resolve_fuzzy(names, "raw", catalog, "name", "id").collect() if r["raw"]}
    assert got == {"San Benitto": 1, "Villa Soll": None, "Centro": 4, "zzz": None} or got == {"San Benitto": 1, "Villa Soll": None, "zzz": None}


def test_similar_adjacent(spark):
    touching = frame(spark, [("A", "PINO NORTE"), ("A", "ROBLE"), ("B", "PINO NORTE"), ("B", "PINO NORTES")], "street string, other string")
    unknown = frame(spark, [("pino nxrte", "A"), ("pino nxrte", "B"), ("qqq", "A"), (None, "A")], "name string, known string")
    got = [(r["name"], r["known"], r["other"]) for r in tx.similar_adjacent(unknown, "name", "known", touching, "street", "other").collect()]
    assert got == [("pino nxrte", "A", "PINO NORTE")]


def test_svd_reconstructs(spark):
    rng = np.random.default_rng(6)
    dense = np.outer(rng.uniform(1, 2, 12), rng.uniform(1, 2, 7)) + 0.5 * np.outer(rng.standard_normal(12), rng.standard_normal(7))
    rows = [(i, f"t{j}", float(dense[i, j])) for i in range(12) for j in range(7)] + [(None, "t0", 1.0)]
    got = tx.truncated_svd(frame(spark, rows, "id long, term string, w double"), "id", "term", "w", 2).collect()
    u, s, _ = np.linalg.svd(dense, full_matrices=False)
    for c in range(2):
        mine = np.array([r["value"] for r in sorted(got, key=lambda r: r["id"]) if r["component"] == c])
        assert np.allclose(np.abs(mine), np.abs(u[:, c] * s[c])) and mine[np.abs(mine).argmax()] > 0
    assert tx.truncated_svd(frame(spark, [], "id long, term string, w double"), "id", "term", "w", 2).count() == 0


def test_clusters_and_contexts(spark):
    rng = np.random.default_rng(7)
    centers = [(0, 0), (30, 0), (0, 30), (30, 30)]
    rows = [(i, float(c[0] + e[0]), float(c[1] + e[1])) for i, (c, e) in enumerate((centers[k % 4], rng.normal(0, 1, 2)) for k in range(80))] + [(100, None, 1.0)]
    df = frame(spark, rows, "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in cluster.kmeans(df, ["x", "y"], 4).collect()}
    assert 100 not in got and len({(i % 4, c) for i, c in got.items()}) == 4 and len(set(got.values())) == 4
    elbow = cluster.elbow_k(df, ["x", "y"], range(2, 8)).collect()
    costs = [r["cost"] for r in sorted(elbow, key=lambda r: r["k"])]
    assert sum(r["best"] for r in elbow) == 1 and next(r["k"] for r in elbow if r["best"]) in (3, 4) and costs[0] > costs[2]
    _, loadings, scores = cluster.pca(df, "id", ["x", "y"], 2)
    x = np.array([r[1:] for r in rows[:80]])
    assert scores.agg(F.var_samp("pc0") + F.var_samp("pc1")).first()[0] == pytest.approx(x.var(axis=0, ddof=1).sum())
    assert loadings.groupBy("component").agg(F.sum(F.col("loading") ** 2).alias("s")).agg(F.min("s"), F.max("s")).first()[0] == pytest.approx(1)
    # the profiles of the reference rules: far, collector, headwater, nearest, whatever the labels
    profile = [(7, 1.0, 3.0, 2.0), (2, 3.5, 1.5, 0.5), (5, 1.2, 4.8, 0.3), (9, 1.3, 2.7, 0.2)]
    named = cluster.relabel_by_profile(frame(spark, profile, "c int, order_median double, level_median double, proximity_ord double"), "c", cluster.CONTEXTS, cluster.REST, number="context")
    assert {r["c"]: (r["context"], r["context_name"]) for r in named.collect()} == {7: (0, "Lejos de la red"), 2: (1, "Junto a colectores"), 5: (2, "Arroyos menores muy cerca"), 9: (3, "Los más cercanos")}


def test_segment_features_skip_disabled(spark):
    xs = [(11, 150.0, 3, 1, 1), (12, 300.0, 1, 4, 1), (13, 600.0, -1, -1, 0), (14, 1200.0, 2, 3, 1)]
    lines = frame(spark, [(i, x, -500.0, x, 500.0) for i, x, *_ in xs], "id long, ax double, ay double, bx double, by double")
    centres = points(spark, [(1, 50.0, 50.0), (2, 1050.0, 50.0)], "place")
    knn = geo.knn_lines(centres, "place", lines, "id")
    got = {r["place"]: r.asDict() for r in knn.collect()}
    assert [got[1][f"id_seg_{k}"] for k in (1, 2, 3)] == [11, 12, 13] and got[1]["dist_seg_1"] == 100 and got[1]["dist_seg_3"] == 550
    assert got[2]["id_seg_1"] == 14 and got[2]["dist_seg_1"] == 150
    attrs = frame(spark, [(i, o, lv, e) for i, _, o, lv, e in xs], "id long, o int, l int, e int")
    feats = {r["place"]: r for r in cluster.segment_features(knn, "place", ["id_seg_1", "id_seg_2", "id_seg_3"], attrs, "id", "e", "o", "l").collect()}
    assert (feats[1]["order_max"], feats[1]["level_min"], feats[1]["order_median"]) == (3, 1, 2)


def test_outlier_detectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (300, 2)))] + [(900, 30.0, 30.0), (901, None, 1.0)]
    df = frame(spark, rows, "id long, x double, y double")
    for got in (stats.isolation_forest(df, "id", ["x", "y"]).collect(), stats.ecod(df, "id", ["x", "y"]).collect()):
        flagged = {r["id"] for r in got if r["outlier"]}
        assert len(got) == 301 and 900 in flagged and len(flagged) <= 7 and max(got, key=lambda r: r["score"])["id"] == 900
    again = {r["id"]: r["score"] for r in stats.isolation_forest(df.repartition(5), "id", ["x", "y"]).collect()}
    assert again == {r["id"]: r["score"] for r in stats.isolation_forest(df, "id", ["x", "y"]).collect()}
    assert stats.ecod(df.limit(0), "id", ["x", "y"]).count() == 0 and stats.isolation_forest(df.limit(0), "id", ["x", "y"]).count() == 0


def test_sort_stable_and_distribution(spark):
    df = frame(spark, [(3, "b"), (1, None), (2, "b"), (4, "a")], "id long, k string").repartition(3)
    assert [r["id"] for r in agg.sort_stable(df, ["k"], ["id"]).collect()] == [1, 4, 2, 3]
    report = quality.distribution_report(frame(spark, [(1.0,), (None,), (3.0,), (10.0,)], "x double"), ["x"]).first()
    assert (report["count"], report["p50"], report["p90"], report["max"]) == (3, 3.0, pytest.approx(8.6), 10.0)
    assert quality.distribution_report(frame(spark, [], "x double"), ["x"]).first()["p50"] is None


def test_exports_in_one_call(spark, tmp_path):
    (tmp_path / "export_uno.csv").write_text('id,text,likes\n1,"a ""q"",\nb",3\n2,,x\n')
    (tmp_path / "export_dos.csv").write_text("likes,id\n7,3\n")
    got = io.union_exports(spark, [f"file://{tmp_path}/export_{n}.csv" for n in ("uno", "dos")], {"id": "bigint", "text": "string", "likes": "int"}, "id", "export_([a-z]+)")
    assert sorted(map(tuple, got.collect())) == [(1, 'a "q",\nb', 3, "uno"), (2, None, None, "uno"), (3, None, 7, "dos")]
    with pytest.raises(ValueError, match="repeated id"):
        io.union_exports(spark, [f"file://{tmp_path}/export_uno.csv"] * 2, {"id": "bigint"}, "id", "export_([a-z]+)")


def test_what_is_checked_is_written(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.rand(1))
    io.write_validated(df, lambda rows: rows.where("x > 2"), f"file://{tmp_path}/out")
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 5
    with pytest.raises(ValueError):
        io.write_validated(df, lambda rows: rows.where("id = 3"), f"file://{tmp_path}/bad")
    assert not (tmp_path / "bad").exists()


def test_mentions_with_long_and_null_texts(spark):
    catalog = frame(spark, [("VILLA SOL", 1), ("VILLA SOL NORTE", 2), ("SAN BENITO", 3), ("SAN BENITO", 9)], "name string, id int")
    rows = [(1, "en la colonia Villa Sol Norte"), (2, "calle San Benito"), (3, None), (4, ""), (5, "x " * 20000 + "San Benito"), (1, "en la colonia Villa Sol Norte")]
    got = sorted((r["k"], r["raw_text"], r["id"], r["match_method"]) for r in tx.dictionary_mentions(frame(spark, rows, "k long, text string"), "k", {"text": "texto"}, catalog, "name", "id").collect())
    assert got == [(1, "VILLA SOL", 1, "colonia_con_marcador"), (5, "SAN BENITO", 3, "colonia_en_catalogo")]


def test_overlaps_against_points(spark):
    """Shared areas of polygons with holes, of either direction, against shares of a fine grid of points."""
    rnd = random.Random(9)
    ring = lambda n, r: [{"x": 5 + r * rnd.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), "y": 5 + r * rnd.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)} for k in range(n)]
    polys = [[ring(rnd.randint(3, 9), 5), *([ring(4, 1.2)] if rnd.random() < 0.5 else [])] for _ in range(12)]
    polys = [[r[::-1] if rnd.random() < 0.5 else r for r in p] for p in polys]
    xs = (np.arange(400) + 0.5) / 40
    gx, gy = (c.ravel() for c in np.meshgrid(xs, xs))

    def held(rings):
        inside = np.zeros(len(gx), bool)
        for r in rings:
            for p, q in zip(r, r[1:] + r[:1], strict=True):
                cross = (p["y"] > gy) != (q["y"] > gy)
                inside ^= cross & (gx < (q["x"] - p["x"]) * (gy - p["y"]) / (q["y"] - p["y"] or 1) + p["x"])
        return inside

    marks = [held(p) for p in polys]
    pairs = [(i, j) for i in range(12) for j in range(12)]
    for chunk in (7, 100_000):
        flat = [[{"ring": n, **q} for n, r in enumerate(p) for q in r] for p in polys]
        got = geo.shared_areas(pd.Series([flat[i] for i, _ in pairs]), pd.Series([flat[j] for _, j in pairs]), chunk)
        want = [(marks[i] & marks[j]).mean() * 100 for i, j in pairs]
        assert np.allclose(got, want, atol=0.15)
    df = frame(spark, [(i, p) for i, p in enumerate(polys)], "id long, rings array<array<struct<x:double,y:double>>>")
    both = geo.polygon_overlap_area(df, "id", df.withColumnRenamed("id", "other"), "other", cell=3.0)
    assert {(r["id"], r["other"]): r["m2"] for r in both.collect()} == pytest.approx({k: v for k, v in zip(pairs, got, strict=True) if v > 1e-6})


@pytest.mark.parametrize("n", [12, 36, 80])
def test_bootstrap_widths_are_those_of_independent_draws(spark, n):
    rng = np.random.default_rng(n)
    tables = {f"s{k}": (rng.gamma(2, 3, n), rng.gamma(2, 2, n)) for k in range(12)}
    rows = [(s, pd.Timestamp(2000 + i // 12, i % 12 + 1, d).date(), mm, float(x)) for s, (wet, dry) in tables.items() for i in range(n) for d, mm, x in ((1, 20.0, wet[i]), (2, 0.0, dry[i]))]
    df = frame(spark, rows, "s string, date date, recent_max_mm double, n double").withColumn("year_month", F.trunc("date", "month"))
    got = {r["s"]: r["high"] - r["low"] for r in events.within_month_interval(df, "s").collect()}
    ratio = []
    for s, (wet, dry) in tables.items():
        picks = rng.integers(0, n, (20_000, n))
        low, high = np.percentile(wet[picks].sum(axis=1) / dry[picks].sum(axis=1), [5, 95])
        ratio.append(got[s] / (high - low))
    assert abs(np.mean(ratio) - 1) < 0.05 and max(abs(r - 1) for r in ratio) < 0.12


@pytest.mark.parametrize("mode,cutoff", [("ratio", 0.85), ("ratio", 0.7), ("ratio", 0.55), ("levenshtein", 0.8), ("levenshtein", 0.5)])
def test_similar_pairs_lose_none_and_meet_few(spark, mode, cutoff):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("ABCDEILNORSTU") for _ in range(rnd.randrange(1, 9)))
    base = [" ".join(word() for _ in range(rnd.randrange(1, 4))) for _ in range(150)]

    def typo(x):
        for _ in range(rnd.randrange(0, 4)):
            i = rnd.randrange(len(x) + 1)
            x = rnd.choice([x[:i] + rnd.choice("AEX ") + x[i:], x[:i] + x[i + 1 :], x[:i] + rnd.choice("AEX") + x[i + 1 :]])
        return x

    left, right = sorted({typo(rnd.choice(base)) for _ in range(160)} | {"A", "AB", "AAAA", "AAAAAA"}), sorted(set(base) | {"A", "B", "AAAAA"})
    one, two = frame(spark, [(x,) for x in left] + [(None,), (left[0],)], "a string"), frame(spark, [(x,) for x in right] + [(None,)], "b string")

    def alike(x, y):
        if mode == "ratio":
            return difflib.SequenceMatcher(None, x, y).ratio()
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row = row, [i]
            for j, d in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        return 1 - row[-1] / max(len(x), len(y))

    want = sorted((x, y) for x in left for y in right if x and y and alike(x, y) >= cutoff)
    got = sorted((r["a"], r["b"]) for r in tx.similar_pairs(one, "a", two, "b", cutoff, mode).collect())
    assert got == want
    if cutoff >= 0.8:
        met = tx.similar_candidates(one, "a", two, "b", cutoff, mode).count()
        assert len(want) <= met < 0.15 * len(left) * len(right)


def test_mentions_in_a_long_text(spark):
    words = ["villa"] * 10_000 + ["otra"] * 30_000
    random.Random(3).shuffle(words)
    words[500:502] = ["villa", "dorada"]
    catalog = frame(spark, [("VILLA DORADA", 1), ("VILLAS DEL SUR", 2)], "name string, cid long")
    docs = frame(spark, [(1, " ".join(words)), (1, " ".join(words)), (2, "calle villa dorada"), (3, "col villa dorada, otra"), (None, "villa dorada"), (4, None)], "id long, t string")
    got = sorted((r["id"], r["raw_text"], r["match_method"]) for r in tx.dictionary_mentions(docs, "id", {"t": "t"}, catalog, "name", "cid").collect())
    assert got == [(1, "VILLA DORADA", "colonia_en_catalogo"), (3, "VILLA DORADA", "colonia_con_marcador")]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path, good = f"file://{tmp_path}/t", frame(spark, [(1,), (2,)], "id long")
    held = lambda: sorted(r["id"] for r in spark.read.parquet(path).collect())
    io.write_validated(good, lambda rows: rows.where("id > 2"), path)
    with pytest.raises(ValueError):
        io.write_validated(frame(spark, [(3,)], "id long"), lambda rows: rows.where("id > 2"), path)
    assert held() == [1, 2]
    with pytest.raises(Exception, match="broke off"):
        io.write_validated(good.select(F.when(F.col("id") == 1, F.col("id")).otherwise(F.raise_error("broke off").cast("long")).alias("id")), lambda rows: rows.where("false"), path)
    assert held() == [1, 2]
    io.write_validated(frame(spark, [(5,)], "id long"), lambda rows: rows.where("false"), path)
    assert held() == [5] and [p.name for p in tmp_path.iterdir()] == ["t"]
    (tmp_path / "t").rename(tmp_path / "t.previous")  # a swap that broke off between its two renames
    io.recover(spark, path)
    assert held() == [5]


def test_profile_counts_values_as_spark_does(spark):
    rows = [(0.0, "a", None, ["a, b"], b"x"), (-0.0, "A", None, ["a", "b"], b"X"), (math.nan, "a", None, None, None), (math.nan, None, None, [], b"x"), (None, "", None, [None], b"")]
    df = frame(spark, rows, "x double, `s.t` string, n long, l array<string>, b binary")
    got = {r["column"]: (r["n_distinct"], round(r["null_percent"], 6)) for r in quality.column_profile(df).collect()}
    assert got == {"x": (2, 20.0), "s.t": (3, 20.0), "n": (0, 100.0), "l": (4, 20.0), "b": (3, 20.0)}
    assert [(r["column"], r["n_distinct"], r["null_percent"]) for r in quality.column_profile(df.limit(0)).collect()][0] == ("x", 0, None)


def star(rnd, cx, cy, n, size):
    """A ring of n corners around a place, with dents."""
    return [{"x": cx + size * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), "y": cy + size * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)} for i in range(n)]


def test_cells_tell_inside_as_whole_polygons_do(spark):
    rnd = random.Random(14)
    shapes = [(i, [star(rnd, rnd.uniform(0, 3000), rnd.uniform(0, 3000), rnd.choice([3, 7, 60]), rnd.choice([40, 900, 2500]))]) for i in range(14)]
    shapes[3][1].append(star(rnd, shapes[3][1][0][0]["x"], shapes[3][1][0][0]["y"], 9, 120))  # a second ring
    box = lambda a, b, c, d: [{"x": a, "y": b}, {"x": c, "y": b}, {"x": c, "y": d}, {"x": a, "y": d}]
    shapes += [(90, [box(100.0, 100.0, 600.0, 500.0)]), (91, [box(0.0, 0.0, 2000.0, 2000.0), box(500.0, 500.0, 1500.0, 1500.0)])]
    polys = frame(spark, shapes, "p long, rings array<array<struct<x:double,y:double>>>")
    places = [(i, rnd.uniform(-500, 3500), rnd.uniform(-500, 3500)) for i in range(400)] + [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate((a, b) for a in (100, 500, 600, 1500, 2000) for b in (100, 500, 1500, 300))]
    pts = frame(spark, [*places, (5000, None, 1.0)], "id long, x double, y double")
    every = pts.where("x is not null").join(polys.select("p", geo.polygon_edges(F.col("rings")).alias("e")), how="cross").where(geo.inside(F.col("e"), F.col("x"), F.col("y")))
    want = {r["id"]: r["m"] for r in every.groupBy("id").agg(F.min("p").alias("m")).collect()}
    for cell in (100.0, 777.0, 50_000.0):
        got = {r["id"]: r["p"] for r in geo.point_in_polygon(pts, "id", polys, "p", cell=cell).collect()}
        assert got == {i: want.get(i) for i in got} and len(got) == len(places) + 1
    lines = frame(spark, [(i, *(rnd.uniform(-200, 3200) for _ in range(4))) for i in range(40)] + [(90, 500.0, -100.0, 500.0, 3000.0), (91, 0.0, 500.0, 3000.0, 500.0)], "id long, ax double, ay double, bx double, by double")
    km = lambda cell: {r["p"]: round(r["km"], 6) for r in geo.line_length_in_polygon(lines, "id", polys, "p", cell=cell).collect()}
    assert km(100.0) == km(777.0) == km(50_000.0) and sum(km(777.0).values()) > 10


def test_cells_of_a_large_polygon_follow_its_edges(spark):
    n = 20_000
    ring = [{"x": 50_000 + 45_000 * math.cos(2 * math.pi * i / n), "y": 50_000 + 45_000 * math.sin(2 * math.pi * i / n)} for i in range(n)]
    index = geo.cell_index(frame(spark, [(1, [ring])], "p long, rings array<array<struct<x:double,y:double>>>"), "p", "rings", 1000.0)
    cells, held = index.agg(F.count("*"), F.sum(F.size("_e"))).first()
    assert 6362 < cells < 6800 and held < 1.1 * n  # the area in cells and a border; an edge is in one or two
