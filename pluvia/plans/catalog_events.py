"""Queries of the event-study operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.operators import events as ev
from pluvia.plans.registry import query

W1 = "rw AS (SELECT date, mm, max(mm) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS r FROM sx_rain)"
SERIES = "s AS (SELECT d.date, k.kind, coalesce(c.n, 0)::BIGINT AS n FROM sx_rain d CROSS JOIN (SELECT DISTINCT kind FROM sx_calls) k LEFT JOIN (SELECT date, kind, count(*) AS n FROM sx_calls GROUP BY ALL) c ON d.date = c.date AND k.kind = c.kind)"
LONG = f"{W1}, {SERIES}, lt AS (SELECT s.*, rw.mm, rw.r, CAST(date_trunc('month', s.date) AS DATE) AS ym FROM s JOIN rw ON s.date = rw.date)"
SEASON = "month({}) BETWEEN 6 AND 10"


def _table(t):
    series = ev.dense_series(t.sx_calls, t.sx_rain, "kind", t.sx_calls)
    return ev.long_table(t.sx_rain, series, "kind")


def _total(t):
    """One series of all calls on the driver's days."""
    counts = t.sx_calls.groupBy("date").agg(F.count("*").alias("n"))
    return t.sx_rain.join(counts, "date", "left").select("date", "mm", F.coalesce("n", F.lit(0)).alias("n"))


TOTAL = "tt AS (SELECT d.date, d.mm, coalesce(c.n, 0)::BIGINT AS n FROM sx_rain d LEFT JOIN (SELECT date, count(*) AS n FROM sx_calls GROUP BY 1) c ON d.date = c.date)"


@query("w1_response_window", "SELECT date, mm, max(mm) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS recent_max_mm FROM sx_rain", d="mm recent_max_mm")
def _(t):
    return ev.response_window(t.sx_rain)


@query("w2_daily_table", f"WITH {W1}, {TOTAL}, f AS (SELECT date, count(*) AS n FROM sx_calls WHERE kind = 'RF' GROUP BY 1) SELECT rw.date, rw.mm, rw.r AS recent_max_mm, tt.n AS calls, f.n AS rf, month(rw.date)::INT AS month, CAST(date_trunc('month', rw.date) AS DATE) AS year_month FROM rw JOIN tt ON rw.date = tt.date LEFT JOIN f ON rw.date = f.date", d="mm recent_max_mm")
def _(t):
    rf = t.sx_calls.where("kind = 'RF'").groupBy("date").agg(F.count("*").alias("n"))
    return ev.daily_table(t.sx_rain, {"calls": _total(t), "rf": rf})


@query("w3_previous_max", "SELECT date, mm, max(mm) OVER (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS previous_max FROM sx_rain", d="mm previous_max")
def _(t):
    return ev.previous_max(t.sx_rain)


@query("w4_centered_median", f"WITH {TOTAL} SELECT date, n, quantile_cont(n, 0.5) OVER (ORDER BY date ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING) AS median, n - quantile_cont(n, 0.5) OVER (ORDER BY date ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING) AS residual FROM tt", d="median residual")
def _(t):
    return ev.centered_median(_total(t).select("date", "n"), "n", "date")


@query("w5_average_rank", "SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS rank FROM lineitem", d="l_quantity rank")
def _(t):
    return ev.average_rank(t.lineitem.select("l_quantity", "l_orderkey", "l_linenumber"), "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity", "rank")


RANKS = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0::DOUBLE"


@query("w6_spearman", f"SELECT count(*) AS n, corr(a, b) AS rho FROM (SELECT {RANKS.format('l_quantity')} AS a, {RANKS.format('l_extendedprice')} AS b FROM lineitem)", d="rho")
def _(t):
    return ev.spearman(t.lineitem, "l_quantity", "l_extendedprice")


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("w6_spearman_matrix", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, corr(x, y) AS rho FROM (SELECT {RANKS.format(a)} AS x, {RANKS.format(b)} AS y FROM lineitem)" for i, a in enumerate(_COLS) for b in _COLS[i + 1 :]), d="rho")
def _(t):
    return ev.spearman_matrix(t.lineitem, _COLS)


@query("w7_lagged_spearman", f"WITH {TOTAL}, l AS (" + " UNION ALL ".join(f"SELECT {k} AS lag, mm AS x, lead(n, {k}) OVER (ORDER BY date) AS y FROM tt" for k in range(6)) + """),
f AS (SELECT * FROM l WHERE y IS NOT NULL), r AS (SELECT lag, rank() OVER (PARTITION BY lag ORDER BY x) + (count(*) OVER (PARTITION BY lag, x) - 1) / 2.0::DOUBLE AS a, rank() OVER (PARTITION BY lag ORDER BY y) + (count(*) OVER (PARTITION BY lag, y) - 1) / 2.0::DOUBLE AS b FROM f)
SELECT lag::INT AS lag, count(*) AS n, corr(a, b) AS rho FROM r GROUP BY 1""", d="rho")
def _(t):
    return ev.lagged_spearman(_total(t), "mm", "n", list(range(6)))


@query("w8_event_study", f"""WITH {LONG} SELECT kind, count(*) FILTER (r >= 10) AS wet_days, avg(n) FILTER (r >= 10) AS wet_mean, count(*) FILTER (r < 1) AS dry_days, avg(n) FILTER (r < 1) AS dry_mean,
avg(n) FILTER (r >= 10) / nullif(avg(n) FILTER (r < 1), 0) AS ratio FROM lt WHERE {SEASON.format('date')} GROUP BY 1""", d="wet_mean dry_mean ratio")
def event_study_query(t):
    return ev.event_study(_table(t), "kind")


WM = f"{LONG}, wm AS (SELECT kind, ym, avg(n) FILTER (r >= 10) AS wet, avg(n) FILTER (r < 1) AS dry FROM lt GROUP BY ALL HAVING count(*) FILTER (r >= 10) > 0 AND count(*) FILTER (r < 1) > 0)"


@query("w9_within_month_ratio", f"WITH {WM} SELECT kind, ym AS year_month, wet, dry, wet / nullif(dry, 0) AS ratio FROM wm", d="wet dry ratio")
def _(t):
    return ev.within_month_ratio(_table(t), "kind")


BOOT = """, rk AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY ym) - 1 AS slot, count(*) OVER (PARTITION BY {k}) AS m FROM wm),
dr AS (SELECT {k}, draw, (('0x' || substr(md5(concat('42-', draw, '-', slot)), 1, 15))::BIGINT % m) AS pick FROM rk CROSS JOIN (SELECT unnest(range(2000))::BIGINT AS draw)),
bs AS (SELECT dr.{k}, draw, sum(wet) / sum(dry) AS r FROM dr JOIN rk ON dr.{k} = rk.{k} AND dr.pick = rk.slot GROUP BY ALL HAVING sum(dry) > 0),
q AS (SELECT {k}, quantile_cont(r, 0.05) AS low, quantile_cont(r, 0.95) AS high FROM bs GROUP BY 1)"""


@query("w10_within_month_interval", f"WITH {WM}{BOOT.format(k='kind')} SELECT wm.kind, count(*) AS months, sum(wet) / nullif(sum(dry), 0) AS ratio, any_value(low) AS low, any_value(high) AS high FROM wm LEFT JOIN q ON wm.kind = q.kind GROUP BY 1", d="ratio low high")
def _(t):
    return ev.within_month_interval(_table(t), "kind")


CUT = "CASE WHEN mm <= -0.1 OR mm > 1000 THEN NULL WHEN mm <= 0.99 THEN 'seco (<1 mm)' WHEN mm <= 9.99 THEN '1 a 10 mm' WHEN mm <= 19.99 THEN '10 a 20 mm' WHEN mm <= 39.99 THEN '20 a 40 mm' ELSE '40 mm o más' END"
DIM = "dim AS (SELECT * FROM (VALUES (0, 'seco (<1 mm)'), (1, '1 a 10 mm'), (2, '10 a 20 mm'), (3, '20 a 40 mm'), (4, '40 mm o más')) v(ord, intensity))"


@query("w11_by_intensity", f"WITH {TOTAL}, {DIM} SELECT ord::INT AS ord, dim.intensity, count(n) AS days, avg(n) AS mean, quantile_cont(n, 0.9) AS bad_day, max(n) AS most FROM dim LEFT JOIN (SELECT n, {CUT} AS i FROM tt WHERE {SEASON.format('date')}) ON i = dim.intensity GROUP BY ALL", d="mean bad_day")
def _(t):
    return ev.by_intensity(_total(t))


@query("w12_event_curve", f"""WITH {TOTAL}, p AS (SELECT *, max(mm) OVER (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pm FROM tt), e AS (SELECT date FROM p WHERE mm >= 20 AND pm < 10)
SELECT k.day::INT AS day, avg(tt.n) AS mean, (SELECT count(*) FROM e) AS events, (SELECT count(*) FROM e WHERE {SEASON.format('date')}) AS in_season, (SELECT avg(n) FROM tt WHERE mm < 1) AS dry_day
FROM (SELECT unnest(range(-3, 8)) AS day) k CROSS JOIN e LEFT JOIN tt ON tt.date = e.date + k.day::INT GROUP BY 1""", d="mean dry_day")
def _(t):
    return ev.event_curve(_total(t))


@query("w13_extra_by_type", f"""WITH {W1}, d AS (SELECT date, CASE WHEN r >= 10 THEN 'wet' WHEN r < 1 THEN 'dry' END AS k FROM rw WHERE {SEASON.format('date')}),
c AS (SELECT kind, count(*) FILTER (k = 'wet') AS w, count(*) FILTER (k = 'dry') AS y FROM sx_calls JOIN d USING (date) WHERE k IS NOT NULL GROUP BY 1)
SELECT kind, w / (SELECT count(*) FROM d WHERE k = 'wet')::DOUBLE AS after_rain, y / (SELECT count(*) FROM d WHERE k = 'dry')::DOUBLE AS dry_days, w / (SELECT count(*) FROM d WHERE k = 'wet')::DOUBLE - y / (SELECT count(*) FROM d WHERE k = 'dry')::DOUBLE AS extra FROM c""", d="after_rain dry_days extra")
def _(t):
    return ev.extra_by_type(t.sx_rain, t.sx_calls, "kind")


@query("w14_hour_profile", f"""WITH {W1}, c AS (SELECT hour, count(*) FILTER (mm >= 10) AS w, count(*) FILTER (r < 1) AS y FROM sx_calls JOIN rw USING (date) GROUP BY 1)
SELECT h.hour::INT AS hour, coalesce(w * 100.0::DOUBLE / sum(w) OVER (), 0) AS rain_day, coalesce(y * 100.0::DOUBLE / sum(y) OVER (), 0) AS dry_day FROM (SELECT unnest(range(24)) AS hour) h LEFT JOIN c ON h.hour = c.hour""", d="rain_day dry_day")
def _(t):
    return ev.hour_profile(t.sx_rain, t.sx_calls)


@query("w15_seasons_with_events", f"WITH {W1} SELECT place_id, count(*) AS events, count(DISTINCT year(date)) AS seasons FROM sx_calls JOIN rw USING (date) WHERE r >= 10 AND place_id IS NOT NULL GROUP BY 1")
def _(t):
    return ev.seasons_with_events(t.sx_rain, t.sx_calls, "place_id")


PLACED = "pd AS (SELECT n_nationkey AS place_id, n_regionkey AS region FROM nation)"
GROUPED = f"{PLACED}, gs AS (SELECT d.date, g.region, coalesce(c.n, 0)::BIGINT AS n FROM sx_rain d CROSS JOIN (SELECT DISTINCT region FROM pd) g LEFT JOIN (SELECT date, region, count(*) AS n FROM sx_calls JOIN pd USING (place_id) {{w}} GROUP BY ALL) c ON d.date = c.date AND g.region = c.region)"


def _dim(t):
    return t.nation.select(F.col("n_nationkey").alias("place_id"), F.col("n_regionkey").alias("region"))


@query("w16_series_by_group", f"WITH {GROUPED.format(w='')} SELECT date, region, n FROM gs")
def _(t):
    return ev.series_by_group(t.sx_calls, t.sx_rain, "place_id", _dim(t), "region")


@query("w17_persistence", "WITH c AS (SELECT place_id, year(date) AS y, count(*) AS c FROM sx_calls WHERE place_id IS NOT NULL GROUP BY ALL), w AS (SELECT place_id, coalesce(sum(c) FILTER (y = 1996), 0) AS a, coalesce(sum(c) FILTER (y = 1997), 0) AS b, coalesce(sum(c) FILTER (y = 1998), 0) AS d FROM c GROUP BY 1) " + " UNION ALL ".join(f"SELECT {y1}::INT AS y1, {y2}::INT AS y2, count(*) AS n, corr(p, q) AS rho FROM (SELECT {RANKS.format(x)} AS p, {RANKS.format(z)} AS q FROM w)" for y1, y2, x, z in ((1996, 1997, "a", "b"), (1997, 1998, "b", "d"))), d="rho")
def _(t):
    return ev.persistence(t.sx_calls, "place_id", [(1996, 1997), (1997, 1998)])


@query("w18_upper_fence_by_group", """
WITH c AS (SELECT kind, date, count(*) AS n FROM sx_calls GROUP BY ALL), q AS (SELECT kind, quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.75) AS b FROM c GROUP BY 1)
SELECT kind, date, n, b + 1.5::DOUBLE * (b - a) AS fence, n > b + 1.5::DOUBLE * (b - a) AS outlier FROM c JOIN q USING (kind)""", d="fence")
def _(t):
    return ev.upper_fence_by_group(t.sx_calls.groupBy("kind", "date").agg(F.count("*").alias("n")), "kind", "n")


@query("w19_annual_compare", "SELECT a.year, a, b FROM (SELECT year(date)::INT AS year, sum(mm) AS a FROM sx_rain GROUP BY 1) a JOIN (SELECT year(date)::INT AS year, count(*)::BIGINT AS b FROM sx_calls GROUP BY 1) b USING (year)", d="a")
def _(t):
    return ev.annual_compare(t.sx_rain, t.sx_calls.withColumn("one", F.lit(1)), "mm", "one")


@query("w20_center_of_group", "SELECT c_nationkey, point_id, x, y, avg(x) OVER (PARTITION BY c_nationkey) AS x_center, avg(y) OVER (PARTITION BY c_nationkey) AS y_center FROM sx_points JOIN customer ON point_id = c_custkey", d="x y x_center y_center")
def _(t):
    df = t.sx_points.join(t.customer.select(F.col("c_custkey").alias("point_id"), "c_nationkey"), "point_id")
    return ev.center_of_group(df, "c_nationkey", ["x", "y"])


AREA = "ar AS (SELECT n_regionkey AS region, sum((x1 - x0) * (y1 - y0)) / 1e6 AS km2 FROM sx_places JOIN nation ON place_id = n_nationkey GROUP BY 1)"


@query("w21_intensity_by_group", f"WITH {GROUPED.format(w='')}, {AREA}, {DIM} SELECT g.region, ord::INT AS ord, dim.intensity, count(n) AS days, avg(n) / any_value(km2) * 100 AS per_100_km2 FROM (SELECT DISTINCT region FROM gs) g CROSS JOIN dim LEFT JOIN (SELECT region, n, {CUT} AS i FROM gs JOIN sx_rain USING (date) WHERE {SEASON.format('date')}) f ON f.region = g.region AND i = dim.intensity LEFT JOIN ar ON ar.region = g.region GROUP BY ALL", d="per_100_km2")
def _(t):
    area = t.sx_places.join(_dim(t), "place_id").groupBy("region").agg((F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))) / 1e6).alias("km2"))
    return ev.intensity_by_group(t.sx_rain, t.sx_calls, "place_id", _dim(t), "region", area)


_W22 = f"""WITH {W1}, {GROUPED.format(w="WHERE kind IN ('RF', 'AF')")}, lt AS (SELECT gs.*, rw.r, CAST(date_trunc('month', gs.date) AS DATE) AS ym FROM gs JOIN rw USING (date)),
wm AS (SELECT region, ym, avg(n) FILTER (r >= 10) AS wet, avg(n) FILTER (r < 1) AS dry FROM lt GROUP BY ALL HAVING count(*) FILTER (r >= 10) > 0 AND count(*) FILTER (r < 1) > 0){BOOT.format(k='region')},
e AS (SELECT region, sum(n)::BIGINT AS events, avg(n) FILTER (r >= 10 AND {SEASON.format('date')}) / nullif(avg(n) FILTER (r < 1 AND {SEASON.format('date')}), 0) AS season_ratio FROM lt GROUP BY 1),
m AS (SELECT region, sum(wet) / nullif(sum(dry), 0) AS month_ratio FROM wm GROUP BY 1)
SELECT e.region, events, season_ratio, month_ratio, low, high FROM e LEFT JOIN m USING (region) LEFT JOIN q USING (region)"""


@query("w22_response_by_group", _W22, d="season_ratio month_ratio low high")
def _(t):
    return ev.response_by_group(t.sx_rain, t.sx_calls, "place_id", _dim(t), "region", ["RF", "AF"], "kind")
