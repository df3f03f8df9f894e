"""Queries of the counting and shaping operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.operators import agg
from pluvia.plans.registry import query

KINDS = ["AF", "NF", "NO", "RF"]
MONTHS = ", ".join(f'count(*) FILTER (m = {m}) AS "{m}"' for m in range(1, 13))
TOTAL12 = " + ".join(f'"{m}"' for m in range(1, 13))


@query("g1_daily_counts", """
SELECT s.date, coalesce(n, 0)::BIGINT AS n FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1997-12-31', INTERVAL 1 DAY)) AS DATE) AS date) s
LEFT JOIN (SELECT date, count(*) AS n FROM sx_calls GROUP BY date) c ON s.date = c.date""")  # fmt: skip
def _(t):
    return agg.daily_counts(t.sx_calls, "date", "1996-01-01", "1997-12-31")


@query("g1_daily_counts_by_kind", """
SELECT s.date, k.kind, coalesce(n, 0)::BIGINT AS n FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS date) s
CROSS JOIN (SELECT DISTINCT kind FROM sx_calls) k LEFT JOIN (SELECT date, kind, count(*) AS n FROM sx_calls GROUP BY ALL) c ON s.date = c.date AND k.kind = c.kind""")  # fmt: skip
def _(t):
    return agg.daily_counts(t.sx_calls, "date", "1996-01-01", "1996-12-31", by="kind")


_RESAMPLE = """
WITH g AS (SELECT {start} AS p, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1),
s AS (SELECT CAST(unnest(generate_series((SELECT min(p) FROM g), (SELECT max(p) FROM g), INTERVAL {step})) AS DATE) AS p)
SELECT {label} AS period, coalesce(n, 0)::BIGINT AS n, coalesce(total, 0)::DOUBLE AS total FROM s LEFT JOIN g ON s.p = g.p"""


@query("g2_resample_week", _RESAMPLE.format(start="CAST(date_trunc('week', o_orderdate) AS DATE)", step="7 DAY", label="CAST(s.p + 6 AS DATE)"), d="total")
def _(t):
    return agg.resample(t.orders, "o_orderdate", "week", {"n": F.count("*"), "total": F.sum("o_totalprice")})


@query("g2_resample_month_end", _RESAMPLE.format(start="CAST(date_trunc('month', o_orderdate) AS DATE)", step="1 MONTH", label="last_day(s.p)"), d="total")
def _(t):
    return agg.resample(t.orders, "o_orderdate", "month_end", {"n": F.count("*"), "total": F.sum("o_totalprice")})


@query("g3_value_counts", "SELECT l_returnflag, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM lineitem GROUP BY 1", d="share")
def _(t):
    return agg.value_counts(t.lineitem, "l_returnflag")


@query("g3_count_by", "SELECT place_id, kind, count(*) AS n FROM sx_calls GROUP BY ALL")
def _(t):
    return agg.count_by(t.sx_calls, ["place_id", "kind"])


@query("g4_crosstab", "SELECT place_id, " + ", ".join(f"""count(*) FILTER (kind = '{k}') / count(*)::DOUBLE AS "{k}" """ for k in KINDS) + f" FROM sx_calls WHERE place_id IS NOT NULL AND kind IN {tuple(KINDS)} GROUP BY 1", d="AF NF NO RF")
def _(t):
    return agg.crosstab(t.sx_calls, "place_id", "kind", KINDS, normalize=True)


@query("g4_crosstab_margins", """
SELECT CASE WHEN grouping(place_id) = 1 THEN 'All' ELSE CAST(place_id AS VARCHAR) END AS place_id, CASE WHEN grouping(kind) = 1 THEN 'All' ELSE kind END AS kind, count(*) AS n
FROM sx_calls WHERE place_id IS NOT NULL GROUP BY CUBE (place_id, kind)""")
def _(t):
    return agg.crosstab_margins(t.sx_calls, "place_id", "kind")


@query("g5_pivot_dense", "SELECT r.hour::INT AS hour, " + ", ".join(f'count(kind) FILTER (wd = {k}) AS "{k}"' for k in range(7)) + " FROM (SELECT unnest(range(24)) AS hour) r LEFT JOIN (SELECT hour, kind, CAST(isodow(date) - 1 AS INT) AS wd FROM sx_calls) c ON r.hour = c.hour GROUP BY 1")
def _(t):
    return agg.pivot_dense(t.sx_calls.select("hour", F.weekday("date").alias("wd")), "hour", "wd", list(range(7)), rows=list(range(24)))


@query("g6_named_agg", """
SELECT l_returnflag, count(l_orderkey) AS n, count(DISTINCT l_partkey) AS parts, avg(l_quantity) AS mean_q, quantile_cont(l_extendedprice, 0.5) AS median_p, max(l_discount) AS max_d,
min_by(l_orderkey, l_orderkey * 10 + l_linenumber) AS first_order, avg((l_quantity > 25)::INT::DOUBLE) AS large, quantile_cont(l_extendedprice, 0.9) AS p90 FROM lineitem GROUP BY 1""", d="mean_q median_p max_d large p90")
def _(t):
    df = t.lineitem.withColumn("_o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return agg.named_agg(df, ["l_returnflag"], {
        "n": ("l_orderkey", "count"), "parts": ("l_partkey", "nunique"), "mean_q": ("l_quantity", "mean"), "median_p": ("l_extendedprice", "median"), "max_d": ("l_discount", "max"),
        "first_order": ("l_orderkey", "first_by", "_o"), "large": (F.col("l_quantity") > 25, "share"), "p90": ("l_extendedprice", "quantile", 0.9),
    })


@query("g7_monthly_share", f"WITH c AS (SELECT year(o_orderdate)::INT AS year, {MONTHS.replace('m =', 'month(o_orderdate) =')} FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1) SELECT year, " + ", ".join(f'round("{m}" / ({TOTAL12})::DOUBLE * 100, 1) AS m{m}' for m in range(1, 13)) + " FROM c", d=" ".join(f"m{m}" for m in range(1, 13)))
def _(t):
    return agg.monthly_share(t.orders, "o_orderdate", [1995, 1996, 1997])


@query("g8_period_share", "SELECT kind, avg((month(date) IN (7, 8, 9))::INT::DOUBLE) AS share, count(*) AS n FROM sx_calls GROUP BY 1", d="share")
def _(t):
    return agg.period_share(t.sx_calls, ["kind"], "date", [7, 8, 9])


@query("g9_gap_days", """
SELECT o_custkey, since, until, datediff('day', since, until)::INT AS days FROM (SELECT o_custkey, u AS until, lag(u) OVER (PARTITION BY o_custkey ORDER BY u) AS since
FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS u FROM orders)) WHERE datediff('day', since, until) > 400""")
def _(t):
    return agg.gap_days(t.orders, "o_orderdate", 400, ["o_custkey"])


@query("g10_missing_periods", """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE month(o_orderdate) % 5 <> 0)
SELECT month FROM (SELECT CAST(unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH)) AS DATE) AS month) s ANTI JOIN m USING (month)""")
def _(t):
    return agg.missing_periods(t.orders.where(F.month("o_orderdate") % 5 != 0), "o_orderdate")


@query("g11_coverage", """
SELECT 'orders' AS source, count(*) AS rows, min(o_orderdate)::DATE AS first, max(o_orderdate)::DATE AS last FROM orders UNION ALL SELECT 'calls', count(*), min(date), max(date) FROM sx_calls""")
def _(t):
    return agg.coverage({"orders": (t.orders, "o_orderdate"), "calls": (t.sx_calls, "date")})


@query("g12_duplicate_count", "SELECT sum(c - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)")
def _(t):
    return agg.duplicate_count(t.documents, ["text", "lang"])


@query("g13_dedupe_first", "SELECT call_id, date, hour, kind, place_id FROM sx_calls QUALIFY row_number() OVER (PARTITION BY place_id, kind, date ORDER BY call_id) = 1")
def _(t):
    return agg.dedupe_first(t.sx_calls, ["place_id", "kind", "date"], ["call_id"])


@query("g14_mode_per_group", "SELECT place_id, kind, n FROM (SELECT place_id, kind, count(*) AS n FROM sx_calls GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY n DESC, kind) = 1")
def _(t):
    return agg.mode_per_group(t.sx_calls, "place_id", "kind")


@query("g15_rate_per_area", """
SELECT a.place_id, a.km2, coalesce(n, 0)::BIGINT AS n, coalesce(n, 0) / a.km2 AS rate FROM (SELECT place_id, (x1 - x0) * (y1 - y0) / 1e6 AS km2 FROM sx_places) a
LEFT JOIN (SELECT place_id, count(*) AS n FROM sx_calls WHERE kind = 'RF' GROUP BY 1) c ON a.place_id = c.place_id""", d="km2 rate")
def _(t):
    area = t.sx_places.select("place_id", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / 1e6).alias("km2"))
    return agg.rate_per_area(agg.count_by(t.sx_calls.where("kind = 'RF'"), ["place_id"]), area, ["place_id"])


_FLAGS = {"big": "l_quantity > 40", "cheap": "l_extendedprice < 20000", "late": "l_linenumber > 3", "none": "l_quantity < 0"}


@query("g17_jaccard_matrix", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, coalesce(count(*) FILTER (({x}) AND ({y})) / nullif(count(*) FILTER (({x}) OR ({y})), 0)::DOUBLE, 0.0) AS jaccard FROM lineitem" for a, x in _FLAGS.items() for b, y in _FLAGS.items()), d="jaccard")
def _(t):
    return agg.jaccard_matrix(t.lineitem.select(*[F.expr(e).alias(n) for n, e in _FLAGS.items()]), list(_FLAGS))


@query("g19_profile_matrix", f"WITH c AS (SELECT place_id, {MONTHS.replace('m =', 'month(date) =')} FROM sx_calls WHERE place_id IS NOT NULL GROUP BY 1) SELECT place_id, " + ", ".join(f'"{m}" / ({TOTAL12})::DOUBLE AS m{m}' for m in range(1, 13)) + f" FROM c WHERE {TOTAL12} >= 100", d=" ".join(f"m{m}" for m in range(1, 13)))
def _(t):
    return agg.profile_matrix(t.sx_calls, "place_id", "date", 100)


@query("g20_chain_relabel", "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'alta' WHEN '2-HIGH' THEN 'alta' WHEN '3-MEDIUM' THEN 'media' ELSE 'otros' END AS o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def _(t):
    return agg.chain_relabel(agg.count_by(t.orders, ["o_orderpriority"]), "o_orderpriority", {"1-URGENT": "alta", "2-HIGH": "alta", "3-MEDIUM": "media"}, "n")


@query("g21_mean_by_month", """
SELECT m.month::INT AS month, coalesce(count(o_orderkey) / (SELECT count(DISTINCT year(o_orderdate)) FROM orders)::DOUBLE, 0) AS mean_n
FROM (SELECT unnest(range(1, 13)) AS month) m LEFT JOIN orders ON month(o_orderdate) = m.month GROUP BY 1""", d="mean_n")
def _(t):
    return agg.mean_by_month(t.orders, "o_orderdate")


@query("g22_share_of_flag", """
SELECT kind, count(*) FILTER (month(date) IN (7, 8, 9)) AS with_flag, count(*) FILTER (month(date) NOT IN (7, 8, 9)) AS without_flag, count(*) AS total, count(*) FILTER (month(date) IN (7, 8, 9)) * 100.0::DOUBLE / count(*) AS percent FROM sx_calls GROUP BY 1""", d="percent")
def _(t):
    return agg.share_of_flag(t.sx_calls, "kind", F.month("date").isin(7, 8, 9))


@query("g24_never_mentioned", """
SELECT n_regionkey, count(*) AS members, count(*) FILTER (p IS NULL) AS never, count(*) FILTER (p IS NULL) * 100.0::DOUBLE / count(*) AS percent
FROM nation LEFT JOIN (SELECT DISTINCT place_id AS p FROM sx_calls WHERE kind = 'AF' AND hour = 3 AND date < DATE '1992-06-01') ON n_nationkey = p GROUP BY 1""", d="percent")
def _(t):
    facts = t.sx_calls.where("kind = 'AF' AND hour = 3 AND date < DATE '1992-06-01'").withColumnRenamed("place_id", "n_nationkey")
    return agg.never_mentioned(t.nation, facts, "n_nationkey", ["n_regionkey"])


@query("l1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", d="o_totalprice")
def _(t):
    return agg.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("l2_sort_stable", "SELECT call_id, kind, date FROM sx_calls")
def _(t):
    return agg.sort_stable(t.sx_calls.select("call_id", "kind", "date"), ["kind", "date"], ["call_id"])


@query("l3_head_per_group", "SELECT l_returnflag, array_to_string(list_sort(list(k)), ',') AS examples FROM (SELECT DISTINCT l_returnflag, l_orderkey AS k FROM lineitem QUALIFY dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) <= 5) GROUP BY 1")
def _(t):
    return agg.head_per_group(t.lineitem, "l_returnflag", "l_orderkey", 5).select("l_returnflag", F.array_join("examples", ",").alias("examples"))


@query("l4_union_by_name", "SELECT n_name AS name, n_regionkey AS region, NULL::VARCHAR AS comment FROM nation UNION ALL SELECT r_name, NULL, r_name FROM region")
def _(t):
    a = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return agg.union_by_name([a, t.region.select(F.col("r_name").alias("comment"), F.col("r_name").alias("name"))]).select("name", "region", "comment")


@query("l5_except_keys", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def _(t):
    return agg.except_keys(t.customer, t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("l5_intersect_keys", "SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def _(t):
    return agg.intersect_keys(t.customer, t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("l6_top_k_per_group", """
SELECT place_id, kind, CASE WHEN row_number() OVER (PARTITION BY place_id ORDER BY n DESC, kind) <= 2 THEN n END AS n FROM (SELECT place_id, kind, count(*) AS n FROM sx_calls GROUP BY ALL)""")
def _(t):
    return agg.top_k_per_group(agg.count_by(t.sx_calls, ["place_id", "kind"]), "place_id", "n", "kind", 2)
