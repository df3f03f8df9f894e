"""Registered queries outside pluvia.llm against their DuckDB oracles, on the smallest tables.

A third of them by default, to keep the run short; PLUVIA_ALL=1 takes all.
"""

import math
import os
import zlib

import duckdb
import pytest

from pluvia.plans.catalog import ORACLES, QUERIES
from pluvia.plans.views import TABLES, Tables

DATA = "/root/testdata/sf0.001"


def chosen(names):
    return sorted(n for n in names if os.environ.get("PLUVIA_ALL") or zlib.crc32(n.encode()) % 3 == 0)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET threads = 2")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    return v if isinstance(v, int) or v is None else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


def close(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-4)) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("name", chosen(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = rows(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want, strict=True) if not close(g, w)]
    assert not bad, bad[:3]


#: Queries without an oracle, by what their rows must keep; test_operators.py holds the operators against brute force.
KEEPS = {
    "k9_resolve_fuzzy": lambda rows, t: len(rows) == t.part.select("p_name").distinct().count() and all(r["score"] is None or 0.88 <= r["score"] <= 1 for r in rows),
    "t10_street_candidates_fuzzy": lambda rows, t: len({tuple(r) for r in rows}) == len(rows) > 0,
    "t11_similar_adjacent": lambda rows, t: all(0.6 <= r["score"] <= 1 for r in rows) and len({(r["name"], r["known"]) for r in rows}) == len(rows),
    "t16_truncated_svd": lambda rows, t: len(rows) == 50 * len({r[0] for r in rows}) and max(abs(r["value"]) for r in rows) <= 1 + 1e-9,
    "m6_isolation_forest": lambda rows, t: 0 < sum(r["outlier"] for r in rows) <= 0.02 * len(rows) + 1 and all(0 < r["score"] < 1 for r in rows),
    "m9_kmeans": lambda rows, t: len(rows) == t.customer.count() and {r["cluster"] for r in rows} == {0, 1, 2, 3} and nearest_mean(rows),
    "m13_hydro_context": lambda rows, t: len(rows) == t.customer.count() and {r["context"] for r in rows if r["context"] is not None} == {0, 1, 2, 3},
    "m14_elbow_k": lambda rows, t: [r["k"] for r in sorted(rows)] == list(range(2, 9)) and sum(r["best"] for r in rows) == 1,
    "m15_pca_scores": lambda rows, t: abs(sum(r["pc0"] for r in rows)) < 1e-3 * len(rows) and sum(r["pc0"] ** 2 for r in rows) >= sum(r["pc1"] ** 2 for r in rows),
    "q13_lineage_table": lambda rows, t: {r["file"] for r in rows} == {f"{n}.parquet" for n in TABLES} and all(len(r["digest"]) == 64 for r in rows),
}


def nearest_mean(rows):
    """Each point lies nearest to the mean of its own cluster, but for those on the way of the last step."""
    mean = {c: [sum(r[v] for r in rows if r["cluster"] == c) / sum(r["cluster"] == c for r in rows) for v in "xy"] for c in range(4)}
    own = sum(r["cluster"] == min(mean, key=lambda c: (r["x"] - mean[c][0]) ** 2 + (r["y"] - mean[c][1]) ** 2) for r in rows)
    return own >= 0.98 * len(rows)


def test_every_query_is_held_to_something():
    assert set(QUERIES) - set(ORACLES) == set(KEEPS)


@pytest.mark.parametrize("name", sorted(set(KEEPS) - {"t16_truncated_svd", "m13_hydro_context"}) + (["t16_truncated_svd", "m13_hydro_context"] if os.environ.get("PLUVIA_ALL") else []))
def test_query_without_oracle(spark, name):
    assert KEEPS[name](QUERIES[name](spark, DATA).collect(), Tables(spark, DATA))
