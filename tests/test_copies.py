"""Tables that hold many copies: places, streets and values that repeat are worked out once, with the results of brute force."""

import gzip
import hashlib
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from pluvia.plans.catalog import ORACLES, QUERIES


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def sizes(monkeypatch):
    """Row counts of the tables that a module writes between its steps."""
    seen = []

    def watch(module):
        real = module.settled

        def counted(df):
            out = real(df)
            seen.append(out.count())
            return out

        monkeypatch.setattr(module, "settled", counted)
        return seen

    return watch


def test_location_precision_where_the_gap_rounds_to_zero(spark, tmp_path):
    ids = frame(spark, [(i, i % 25) for i in range(400)], "s_suppkey long, s_nationkey int")
    ids.write.parquet(str(tmp_path / "supplier.parquet"))
    got = {r["line_id"]: r["label"] for r in QUERIES["s27_location_precision"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    assert got == dict(con.execute(ORACLES["s27_location_precision"]).fetchall()) and got[100] == "cruce aproximado (0 m)"


def test_nearest_asks_once_for_each_place(spark, sizes):
    from pluvia.operators import geo, kd

    rnd = random.Random(1)
    spots = [(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(12)]
    pts = [(i, *map(float, rnd.choice(spots))) for i in range(400)]
    lines = [(i, float(x), float(y), float(x + 3), float(y)) for i in range(60) for x, y in [rnd.choice(spots)]]
    seen = sizes(kd)
    left = geo.segments(frame(spark, pts, "id long, x double, y double"), "id")
    right = frame(spark, lines, "other long, ax double, ay double, bx double, by double")
    got = sorted((r["id"], r["other"], r["r"]) for r in geo.nearest(left, "id", right, "other", 3).collect())
    far = lambda p, s: math.hypot(max(s[1] - p[1], 0, p[1] - s[3]), s[2] - p[2])
    want = [(p[0], s[0], r + 1) for p in pts for r, s in enumerate(sorted(lines, key=lambda s: (round(far(p, s), 9), s[0]))[:3])]
    assert got == sorted(want) and max(seen) <= 60


def test_within_distance_compares_each_place_once(spark, monkeypatch):
    from pluvia.operators import geo

    rnd = random.Random(2)
    spots = [(rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(9)]
    a = [(i, *map(float, s), *map(float, s)) for i in range(150) for s in [rnd.choice(spots)]]
    b = [(i, float(x), float(y), float(x + 4), float(y)) for i in range(80) for x, y in [rnd.choice(spots)]]
    b += [(7, 50.0, 50.0, 51.0, 50.0), (3, 0.0, 0.0, 0.0, 30.0)]  # features of two pieces
    met, real = [], geo.near_segments
    monkeypatch.setattr(geo, "near_segments", lambda a, key, b, *rest: met.append((a.count(), b.count())) or real(a, key, b, *rest))
    kinds = "{} long, ax double, ay double, bx double, by double"
    got = sorted((r["p"], r["q"], round(r["d"], 9)) for r in geo.within_distance(frame(spark, a, kinds.format("p")), "p", frame(spark, b, kinds.format("q")), "q", 3.0).collect())
    best = {}
    for p in a:
        for q in b:
            d = math.hypot(max(q[1] - p[1], 0, p[1] - q[3]), max(q[2] - p[2], 0, p[2] - q[4]))
            if d <= 3:
                best[p[0], q[0]] = min(d, best.get((p[0], q[0]), 9))
    assert got == sorted((*k, round(d, 9)) for k, d in best.items())
    assert met[0][0] <= 9 and met[0][1] <= 9 + 4


def test_equal_streets_cross_once(spark, sizes):
    from pluvia.operators import geo

    streets = [(f"L{i}", float(i % 3), 0.0, float(i % 3), 9.0) for i in range(20)] + [(f"F{i}", -5.0, float(1 + i % 4), 9.0, float(1 + i % 4)) for i in range(20)]
    lines = frame(spark, streets, "street string, xa double, ya double, xb double, yb double").select("street", geo.line((F.col("xa"), F.col("ya")), (F.col("xb"), F.col("yb"))).alias("points"))
    pairs = frame(spark, [(i, j, f"L{i}", f"F{j}") for i in range(20) for j in range(20)], "i long, j long, a string, b string")
    seen = sizes(geo)
    got = sorted((r["i"], r["j"], round(r["x"], 6), round(r["y"], 6), r["gap"]) for r in geo.crossing_points(pairs, "a", "b", lines, "street").collect())
    assert got == sorted((i, j, float(i % 3), float(1 + j % 4), 0.0) for i in range(20) for j in range(20))
    assert sum(n >= 400 for n in seen) == 1  # the pairs themselves


def test_lof_fixes_the_neighbours(spark, sizes):
    from pluvia.operators import stats

    rnd = random.Random(3)
    pts = frame(spark, [(i, float(rnd.randint(0, 5)), float(rnd.randint(0, 5))) for i in range(80)], "id long, x double, y double")
    near = stats.neighbours(pts, "id", ["x", "y"], 4)
    seen = sizes(stats)
    assert stats.lof(near, "id").count() == 80 and 320 in seen


def test_spearman_matrix_stacks_equal_rows_once(spark, sizes):
    from pluvia.operators import events

    base = [(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 7.0, None), (4.0, 7.0, 1.0), (5.0, 6.0, 2.0), (6.0, 9.0, 2.0), (None, 3.0, 8.0)]
    rows = [r for i, r in enumerate(base) for _ in range(10 + i)]
    seen = sizes(events)
    got = {(r["a"], r["b"]): (r["n"], r["rho"]) for r in events.spearman_matrix(frame(spark, rows, "u double, v double, w double"), ["u", "v", "w"]).collect()}
    assert seen[0] == len(base)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        kept = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        ranks = [[sum(y < x for y in c) + (c.count(x) + 1) / 2 for x in c] for c in map(list, zip(*kept))]
        m = (len(kept) + 1) / 2
        rho = sum((x - m) * (y - m) for x, y in zip(*ranks)) / math.sqrt(math.prod(sum((x - m) ** 2 for x in c) for c in ranks))
        n, r = got["uvw"[i], "uvw"[j]]
        assert n == len(kept) and abs(r - rho) < 1e-12
    flat = events.spearman(frame(spark, [(0.1, 1.0)] * 3 + [(0.1, 2.0)], "x double, y double"), "x", "y").first()
    assert tuple(flat) == (4, None)


def test_quantiles_and_distinct_values_are_rows(spark):
    import numpy as np

    from pluvia.operators import agg

    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, *map(float, range(9))]), rnd.randint(0, 6)) for _ in range(300)] + [("c", None, 1)]
    df = agg.named_agg(frame(spark, rows, "k string, v double, w int"), ["k"], {"m": ("v", "median"), "n": ("v", "count"), "u": ("w", "nunique"), "q": (F.col("v"), "quantile", 0.9)})
    assert df.columns == ["k", "m", "n", "u", "q"] and "percentile" not in df._jdf.queryExecution().toString()
    got = {r["k"]: tuple(r)[1:] for r in df.collect()}
    assert got.pop("c") == (None, 0, 1, None) and len(got) == 3
    for k, (m, n, u, q) in got.items():
        v = [r[1] for r in rows if r[0] == k and r[1] is not None]
        assert (n, u) == (len(v), len({r[2] for r in rows if r[0] == k})) and math.isclose(m, np.quantile(v, 0.5)) and math.isclose(q, np.quantile(v, 0.9))


def test_tfidf_counts_terms_where_texts_lie(spark):
    from collections import Counter

    from pluvia.functions import text as tx

    docs = [(1, "aa bb aa"), (2, "bb cc"), (2, "cc dd bb"), (3, None), (4, ""), (5, "aa bb zz"), (6, "aa")]
    df = tx.tfidf(frame(spark, docs, "id long, t string"), "id", "t", min_df=2, max_df=0.6)
    plan = df._jdf.queryExecution().toString()
    assert "Window" not in plan
    tf = {}
    for i, t in docs:
        w = (t or "").split()
        tf.setdefault(i, Counter()).update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df_ = Counter(x for c in tf.values() for x in c)
    n, want = len(docs), {}
    for i, c in tf.items():
        w = {x: (1 + math.log(k)) * (math.log((1 + n) / (1 + df_[x])) + 1) for x, k in c.items() if 2 <= df_[x] <= 0.6 * n}
        want |= {(i, x): v / math.sqrt(sum(z * z for z in w.values())) for x, v in w.items()}
    got = {(r["id"], r["term"]): r["weight"] for r in df.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("block", [4096, 5])
def test_similar_adjacent_scores_a_name_once_for_streets_that_touch_the_same(spark, sizes, monkeypatch, block):
    """Every pair scored, as before; lists of 5 are put together from several tasks."""
    import difflib

    from pluvia.functions import text as tx

    monkeypatch.setattr(tx, "BLOCK_OTHERS", block)
    rnd = random.Random(5)
    kinds = ("PINO ", "ROBLE ALTO ", "CEDRO ", "OLMO DEL RIO ")
    spots = [[f"{kinds[rnd.randrange(4)]}{rnd.randrange(10 ** rnd.randint(1, 5))}" for _ in range(rnd.randint(1, 6))] for _ in range(8)]
    near = [(i, j) for i in range(8) for j in range(8) if i == j or abs(i - j) in (1, 4)]
    links = {(a, b) for i, j in near for a in spots[i] for b in spots[j] if a != b} | {("LONE", "PINO 1"), ("LONE", "LONE")}
    asked = {(rnd.choice(kinds).lower().replace("o", "x") + str(rnd.randrange(100)) if rnd.random() < 0.3 else b.lower().replace("o", "x"), a) for a, b in links} | {(None, "LONE"), ("lone", "LONE")}
    seen = sizes(tx)
    norm = lambda n: (n or "").upper()
    want = set()
    for name, known in asked:
        scored = sorted((-difflib.SequenceMatcher(None, norm(name), o).ratio(), o) for k, o in links if k == known)
        if -scored[0][0] >= 0.6 and (len(scored) == 1 or scored[1][0] - scored[0][0] >= 0.1):
            want.add((name, known, scored[0][1], -scored[0][0]))
    got = tx.similar_adjacent(frame(spark, sorted(asked, key=str), "name string, known string"), "name", "known", frame(spark, sorted(links), "street string, other string"), "street", "other")
    assert {tuple(r) for r in got.collect()} == want and len(want) > 20
    assert len({k for k, _ in links}) > 8 and 9 in seen  # classes of streets, not streets


def test_digests_of_long_files_go_by_ranges(spark, tmp_path, monkeypatch):
    from pluvia.sources import io

    rnd = random.Random(4)
    noise = rnd.randbytes(60000)
    files = {
        "short": b"abc", "edge": noise[:8192], "noise": noise, "ends": noise[:30000] + b"\n", "two": noise[:30001] + b"\n\n", "mark": b"\xef\xbb\xbf" + noise,
        "mark_ends": b"\xef\xbb\xbf" + noise[:30000] + b"\n", "feeds": b"\n" * 20000, "returns": b"a\r\n\r" * 9000, "one_line": b"x" * 30000, "a[1]{b}*?": noise[:20000], "p.parquet": noise[::-1], "z.gz": gzip.compress(noise[:7000]), "é ñ%20": noise[5:],
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(io, "DIGEST_BYTES", 8192)
    limits = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.sources.binaryFile.maxLength": "8192"}  # no file above that may be one row
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path / "noise")).rdd.getNumPartitions() > 5
        got = [(r["path"].rsplit("/", 1)[1], r["length"], r["digest"]) for r in io.file_digests(spark, str(tmp_path)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted((name, len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items())


def test_texts_are_read_once_for_mentions(spark, monkeypatch):
    from pluvia.functions import text as tx

    rnd = random.Random(5)
    words = ["calle", "col", "colonia", "Villa", "VILLA", "sol", "Sól", "norte", "San", "Benito", "del", "Arco", "misión,", "y", ".", "x", "av", "ı", "él"]
    rows = [(rnd.choice([None, *range(40)]), " ".join(rnd.choices(words, k=rnd.randint(0, 60))) or None, rnd.choice([None, "", "villa sol", "Ave. San Benito"])) for _ in range(150)]
    docs = frame(spark, rows + rows[:20], "k long, a string, b string").coalesce(1)
    catalog = frame(spark, [("VILLA SOL", 1), ("VILLA SOL NORTE", 2), ("SAN BENITO", 3), ("SAN BENITO", 9), ("MISION DEL ARCO", 4), ("SOL NORTE", 5), ("VILLA", 6), ("EL VILLA X", 7), (None, 8)], "name string, id int")
    for prefer in ("first", "longest"):
        found = lambda: tx.dictionary_mentions(docs, "k", {"a": "texto", "b": "ocr"}, catalog, "name", "id", prefer=prefer)  # noqa: B023, E731
        here = found()
        plan = here._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("translate(") == 2 and "RepartitionByExpression" in plan  # one for each field
        with monkeypatch.context() as m:
            m.setattr(tx, "HELD_NAMES", 0)
            joined = sorted(map(tuple, found().collect()))
        assert sorted(map(tuple, here.collect())) == joined and len({r[2] for r in joined}) > 3
    assert tx.dictionary_mentions(docs, "k", {"a": "texto"}, catalog.limit(0), "name", "id").count() == 0


def test_crossings_and_names_as_by_the_plain_patterns(spark):
    from pluvia.functions import text as tx

    rnd = random.Random(6)
    words = "calle Calle CALLE subcalle callejón CALLEJÓN camino CAMİNO camıno carretera bulevar blvr. Blvd blvd. avenida av av. AV periférico PERIFÉRICO prolongación retorno RETORNO c pe Rosales Ñandú y Y entre ENTRE Dos , .".split()
    docs = frame(spark, [(i, rnd.choice([" ", "\t", "  "]).join(rnd.choices(words, k=rnd.randint(1, 50)))) for i in range(400)], "k long, t string").coalesce(1)
    plain = docs.select("k", F.explode(F.regexp_extract_all("t", F.lit("(?iuU)" + tx.CROSSING), F.lit(1))).alias("e")).select("k", F.trim("e")).distinct()
    found = tx.extract_crossings(docs, "k", {"t": "texto"})
    assert "RepartitionByExpression" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.select("k", "expression").collect())) == sorted(map(tuple, plain.collect())) and plain.count() > 300
    every = frame(spark, [(f" a{chr(c)}b {chr(c)}",) for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000], "t string")
    bare = F.regexp_replace(F.translate("t", tx._ACCENTED, tx._PLAIN), r"[̀-ͯ]", "")
    old = F.trim(F.regexp_replace(F.regexp_replace(F.upper(bare), "[^A-Z0-9 ]", " "), r"\s+", " "))
    assert every.where((tx.strip_accents(F.col("t")) != bare) | (tx.normalize_name(F.col("t")) != old)).count() == 0
