"""Queries of statistics, clusters and data quality, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.operators import cluster as cl
from pluvia.operators import quality as ql
from pluvia.operators import stats as st
from pluvia.plans.registry import query
from pluvia.plans.views import TABLES
from pluvia.sources import io

_V = """(SELECT '{a}' AS a, '{b}' AS b, CASE WHEN r > 1 AND k > 1 AND n > 1 THEN sqrt(greatest(0, phi2 - (r - 1) * (k - 1) / (n - 1)::DOUBLE) / (least(r - (r - 1) * (r - 1) / (n - 1)::DOUBLE, k - (k - 1) * (k - 1) / (n - 1)::DOUBLE) - 1)) END AS v
FROM (SELECT count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS k, count(*) AS n FROM {t}) x CROSS JOIN (SELECT sum(o * o / (ra * rb)::DOUBLE) - 1 AS phi2 FROM (SELECT {a}, {b}, count(*) AS o FROM {t} GROUP BY ALL) JOIN (SELECT {a}, count(*) AS ra FROM {t} GROUP BY 1) USING ({a}) JOIN (SELECT {b}, count(*) AS rb FROM {t} GROUP BY 1) USING ({b})) y)"""
_CV = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query("m1_cramers_v", " UNION ALL ".join(_V.format(a=a, b=b, t="lineitem") for i, a in enumerate(_CV) for b in _CV[i + 1 :]), d="v")
def _(t):
    return st.cramers_v_matrix(t.lineitem, _CV)


@query("m2_correlation_ratio", "WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) AS v FROM lineitem GROUP BY 1), t AS (SELECT avg(l_extendedprice) AS mean FROM lineitem) SELECT sqrt(sum(n * (m - mean) ** 2) / (sum(n * (m - mean) ** 2) + sum(n * v))) AS eta FROM g CROSS JOIN t", d="eta")
def _(t):
    return st.correlation_ratio(t.lineitem, "l_returnflag", "l_extendedprice")


@query("m3_iqr_outliers", "WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders) SELECT o_orderkey, (o_totalprice > b + 0.5::DOUBLE * (b - a) OR o_totalprice < a - 0.5::DOUBLE * (b - a)) AS outlier FROM orders CROSS JOIN q")
def _(t):
    return st.iqr_outliers(t.orders, "o_totalprice", 0.5).select("o_orderkey", "outlier")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("m4_pearson_log", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, corr(ln(1 + {a}), ln(1 + {b})) AS r_log, abs(corr(ln(1 + {a}), ln(1 + {b}))) >= 0.6 AS strong FROM lineitem" for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]), d="r r_log")
def _(t):
    return st.pearson_log(t.lineitem, _NUM)


def _features(t):
    """Per customer: orders, total and balance."""
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").cast("double").alias("orders"), F.sum("o_totalprice").alias("total"))
    return t.customer.select("c_custkey", "c_acctbal", "c_nationkey").join(sums, "c_custkey")


FEATURES = "f AS (SELECT c_custkey, c_acctbal, c_nationkey, count(*)::DOUBLE AS orders, sum(o_totalprice) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)"
_ECOD = f"WITH {FEATURES}, n AS (SELECT count(*)::DOUBLE AS n FROM f), s AS (SELECT c_custkey, " + " + ".join(f"-ln(least(count(*) OVER (ORDER BY {c} RANGE UNBOUNDED PRECEDING), count(*) OVER (ORDER BY {c} DESC RANGE UNBOUNDED PRECEDING)) / n)" for c in ("c_acctbal", "orders", "total")) + " AS score FROM f CROSS JOIN n) SELECT c_custkey, score, score > (SELECT quantile_cont(score, 0.98) FROM s) AS outlier FROM s"


@query("m5_ecod", _ECOD, d="score")
def _(t):
    return st.ecod(_features(t), "c_custkey", ["c_acctbal", "orders", "total"])


@query("m6_isolation_forest", None)
def _(t):
    return st.isolation_forest(_features(t), "c_custkey", ["c_acctbal", "orders", "total"])


@query("m7_lof", """
WITH p AS (SELECT a.point_id, b.point_id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM sx_points a JOIN sx_points b ON a.point_id <> b.point_id),
k AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, other) AS r FROM p QUALIFY r <= 20), kd AS (SELECT point_id AS other, max(d) AS kd FROM k GROUP BY 1),
l AS (SELECT point_id, 1 / (avg(greatest(d, kd)) + 1e-10::DOUBLE) AS lrd FROM k JOIN kd USING (other) GROUP BY 1), s AS (SELECT k.point_id, avg(o.lrd) / any_value(l.lrd) AS score FROM k JOIN l ON k.point_id = l.point_id JOIN l o ON k.other = o.point_id GROUP BY 1)
SELECT point_id, score, score > (SELECT quantile_cont(score, 0.98) FROM s) AS outlier FROM s""", d="score")
def _(t):
    return st.lof(st.neighbours(t.sx_points, "point_id", ["x", "y"], 20), "point_id")


@query("m8_outlier_votes", "WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders), v AS (SELECT o_orderstatus = 'F' AS f, (o_totalprice > b + 0.2::DOUBLE * (b - a))::INT + (month(o_orderdate) = 12)::INT + (o_orderkey % 5 = 0)::INT AS votes FROM orders CROSS JOIN q) SELECT count(*) AS rows, count(*) FILTER (votes >= 2) AS voted, avg(f::INT::DOUBLE) FILTER (votes >= 2) AS rate, avg(f::INT::DOUBLE) AS base, avg(f::INT::DOUBLE) FILTER (votes >= 2) / avg(f::INT::DOUBLE) AS lift FROM v", d="rate base lift")
def _(t):
    df = st.iqr_outliers(t.orders, "o_totalprice", 0.2, high_only=True).withColumn("b", F.month("o_orderdate") == 12).withColumn("c", F.col("o_orderkey") % 5 == 0)
    return st.vote_lift(st.outlier_votes(df, ["outlier", "b", "c"]), F.col("votes"), F.col("o_orderstatus") == "F")


@query("m9_kmeans", None)
def _(t):
    return cl.kmeans(t.sx_points, ["x", "y"], 4)


@query("m10_relabel_by_mean", "WITH m AS (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer GROUP BY 1), r AS (SELECT c_nationkey, row_number() OVER (ORDER BY m, c_nationkey) - 1 AS o FROM m) SELECT c_custkey, c_nationkey, o::INT AS level_ord, CASE o WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' END AS level FROM customer JOIN r USING (c_nationkey)")
def _(t):
    return cl.relabel_by_mean(t.customer, "c_nationkey", "c_acctbal", ["a", "b", "c"]).select("c_custkey", "c_nationkey", "level_ord", "level")


@query("m11_relabel_by_profile", f"""WITH {FEATURES}, p AS (SELECT c_nationkey, avg(total) AS a, avg(orders) AS b FROM f GROUP BY 1), s1 AS (SELECT c_nationkey FROM p ORDER BY a DESC, c_nationkey LIMIT 1), s2 AS (SELECT c_nationkey FROM p ANTI JOIN s1 USING (c_nationkey) ORDER BY b DESC, c_nationkey LIMIT 1)
SELECT c_custkey, CASE WHEN c_nationkey IN (FROM s1) THEN 'gasto' WHEN c_nationkey IN (FROM s2) THEN 'pedidos' ELSE 'resto' END AS context_name FROM f""")
def _(t):
    return cl.relabel_by_profile(_features(t), "c_nationkey", [("total", "gasto"), ("orders", "pedidos")], "resto").select("c_custkey", "context_name")


_KNN = "(SELECT point_id, 1 + point_id % (SELECT max(line_id) FROM sx_lines) AS a, 1 + (point_id * 7) % (SELECT max(line_id) FROM sx_lines) AS b FROM sx_points)"


@query("m12_segment_features", f"""SELECT k.point_id, order_median, order_max, level_median, level_min FROM {_KNN} k LEFT JOIN (SELECT point_id, quantile_cont(strahler, 0.5) AS order_median, max(strahler) AS order_max, quantile_cont(xa, 0.5) AS level_median, min(xa) AS level_min
FROM (SELECT point_id, unnest([a, b]) AS line_id FROM {_KNN}) JOIN sx_lines USING (line_id) WHERE enabled = 1 GROUP BY 1) f ON k.point_id = f.point_id""", d="order_median level_median level_min")
def _(t):
    most = t.sx_lines.agg(F.max("line_id").alias("m"))
    knn = t.sx_points.join(F.broadcast(most), how="cross").select("point_id", (1 + F.col("point_id") % F.col("m")).alias("a"), (1 + F.col("point_id") * 7 % F.col("m")).alias("b"))
    return cl.segment_features(knn, "point_id", ["a", "b"], t.sx_lines, "line_id", "enabled", "strahler", "xa")


@query("m14_elbow_k", None)
def _(t):
    return cl.elbow_k(t.sx_points, ["x", "y"])


@query("m15_pca_variance", f"WITH {FEATURES} SELECT var_samp(c_acctbal) + var_samp(orders) + var_samp(total / 1000) AS trace, 1.0::DOUBLE AS cumulative FROM f", d="trace cumulative")
def _(t):
    df = _features(t).withColumn("total", F.col("total") / 1000)
    cols = ["c_acctbal", "orders", "total"]
    variance, _, scores = cl.pca(df, "c_custkey", cols, 3)
    trace = scores.agg((F.var_samp("pc0") + F.var_samp("pc1") + F.var_samp("pc2")).alias("trace"))
    return trace.join(variance.agg(F.max("cumulative").alias("cumulative")), how="cross")


@query("m15_pca_scores", None)
def _(t):
    return cl.pca(cl.standardise(_features(t), ["c_acctbal", "orders", "total"]), "c_custkey", ["c_acctbal_s", "orders_s", "total_s"], 2)[2]


@query("m16_kruskal_wallis", """
WITH r AS (SELECT l_returnflag, l_quantity, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS r FROM lineitem), g AS (SELECT l_returnflag, count(*) AS n, sum(r) AS s FROM r GROUP BY 1),
b AS (SELECT sum(n)::DOUBLE AS n, sum(s * s / n) AS q, count(*) - 1 AS df FROM g), t AS (SELECT sum(c ** 3 - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM lineitem GROUP BY l_quantity)) SELECT (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n ** 3 - n)) AS h, df::BIGINT AS df FROM b CROSS JOIN t""", d="h")
def _(t):
    return st.kruskal_wallis(t.lineitem, "l_returnflag", "l_quantity").drop("p")


@query("m17_cluster_crosstab", "SELECT c_nationkey, c_mktsegment, count(*) AS n, any_value(m) AS mean_c_acctbal FROM customer JOIN (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer GROUP BY 1) USING (c_nationkey) GROUP BY 1, 2", d="mean_c_acctbal")
def _(t):
    return cl.cluster_crosstab(t.customer, "c_nationkey", "c_mktsegment", ["c_acctbal"])


def _rules():
    return [
        ql.not_null("place_id"), ql.unique("call_id"), ql.unique("date", "kind", "hour"), ql.in_range("hour", 0, 22), ql.in_set("kind", ["RF", "AF"]), ql.full_match("kind", "[A-Z]F"),
        ql.predicate("late_kind", (F.col("kind") != "NO") | (F.col("hour") < 20), "kind"),
    ]


def _broken(col, rule, value, where):
    return f"SELECT '{col}' AS \"column\", '{rule}' AS rule, count(*)::BIGINT AS failing, array_to_string((SELECT list(v ORDER BY v) FROM (SELECT DISTINCT {value} AS v FROM sx_calls WHERE {where} ORDER BY 1 LIMIT 5)), '|') AS examples FROM sx_calls WHERE {where} HAVING count(*) > 0"


_Q1 = " UNION ALL ".join([
    _broken("place_id", "not_null", "coalesce(CAST(place_id AS VARCHAR), 'null')", "place_id IS NULL"), _broken("hour", "in_range(0, 22)", "CAST(hour AS VARCHAR)", "NOT hour BETWEEN 0 AND 22"),
    _broken("kind", "in_set", "kind", "kind NOT IN ('RF', 'AF')"), _broken("kind", "full_match([A-Z]F)", "kind", "NOT regexp_matches(kind, '^[A-Z]F$')"), _broken("kind", "late_kind", "kind", "NOT (kind <> 'NO' OR hour < 20)"),
    """SELECT 'call_id', 'unique', sum(c)::BIGINT, array_to_string(list(CAST(call_id AS VARCHAR) ORDER BY CAST(call_id AS VARCHAR))[1:5], '|') FROM (SELECT call_id, count(*) AS c FROM sx_calls GROUP BY ALL HAVING count(*) > 1) HAVING count(*) > 0""",
    """SELECT 'date+kind+hour', 'unique', sum(c)::BIGINT, array_to_string(list(concat(date, '|', kind, '|', hour) ORDER BY concat(date, '|', kind, '|', hour))[1:5], '|') FROM (SELECT date, kind, hour, count(*) AS c FROM sx_calls GROUP BY ALL HAVING count(*) > 1) HAVING count(*) > 0""",
])


@query("q1_validate", _Q1)
def _(t):
    return ql.validate(t.sx_calls, _rules()).withColumn("examples", F.array_join("examples", "|"))


@query("q2_validate_all", f"SELECT *, 'calls' AS \"table\" FROM ({_Q1}) UNION ALL SELECT 'n_regionkey', 'in_range(0, 3)', count(*)::BIGINT, '4', 'nation' FROM nation WHERE n_regionkey > 3")
def _(t):
    report = ql.validate_all({"calls": t.sx_calls, "nation": t.nation, "region": t.region}, {"calls": _rules(), "nation": [ql.in_range("n_regionkey", 0, 3)]})
    return report.withColumn("examples", F.array_join("examples", "|"))


def _profile(cols):
    part = "SELECT '{c}' AS \"column\", '{k}' AS type, 100.0::DOUBLE * (count(*) - count({c})) / count(*) AS null_percent, count(DISTINCT {c}) AS n_distinct, {a} AS min, {b} AS max FROM sx_calls"
    return " UNION ALL ".join(part.format(c=c, k=k, a="NULL" if k == "string" else f"CAST(min({c}) AS VARCHAR)", b="NULL" if k == "string" else f"CAST(max({c}) AS VARCHAR)") for c, k in cols)


_CALLS = [("call_id", "bigint"), ("date", "date"), ("hour", "int"), ("kind", "string"), ("place_id", "int")]


@query("q3_column_profile", _profile(_CALLS), d="null_percent")
def _(t):
    return ql.column_profile(t.sx_calls)


@query("q4_data_dictionary", f"SELECT p.*, concat('about ', \"column\") AS description, 'one call' AS grain, CASE WHEN type = 'string' THEN 'range withheld' END AS note FROM ({_profile(_CALLS)}) p", d="null_percent")
def _(t):
    return ql.data_dictionary(t.sx_calls, {c: f"about {c}" for c, _ in _CALLS}, "one call")


@query("q5_missing_table", "SELECT 'ocr_text' AS \"column\", count(*) FILTER (ocr_text IS NULL) AS nulls, 0::BIGINT AS empty, 100.0::DOUBLE * count(*) FILTER (ocr_text IS NULL) / count(*) AS percent FROM sx_notices UNION ALL SELECT 'slug', 0, count(*) FILTER (post_id % 4 = 0), 100.0::DOUBLE * count(*) FILTER (post_id % 4 = 0) / count(*) FROM sx_notices", d="percent")
def _(t):
    return ql.missing_table(t.sx_notices.select("post_id", "ocr_text", "text", F.when(F.col("post_id") % 4 == 0, " ").otherwise(F.col("source_slug")).alias("slug")))


@query("q6_table_overview", "SELECT count(*) AS rows, 4::BIGINT AS columns, count(*) FILTER (place_id IS NULL)::BIGINT AS missing_cells, 1::BIGINT AS columns_missing, (SELECT sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM sx_calls GROUP BY date, hour, kind, place_id)) AS duplicates, 2::BIGINT AS numeric, 1::BIGINT AS text FROM sx_calls")
def _(t):
    return ql.table_overview(t.sx_calls.drop("call_id"))


@query("q7_profile_alerts", """SELECT * FROM (VALUES ('place_id', 'missing'), ('one', 'constant'), ('rare', 'imbalanced'), ('hour0', 'zeros')) v("column", alert)""")
def _(t):
    df = t.sx_calls.select("call_id", "place_id", "kind", F.lit("x").alias("one"), F.when(F.col("call_id") % 50 == 1, "a").otherwise("b").alias("rare"), F.when(F.col("hour") < 12, 0).otherwise(F.col("hour")).alias("hour0"))
    return ql.profile_alerts(df.withColumn("hour0", F.col("hour0").cast("int")).withColumn("place_id", F.col("place_id") + 1))


@query("q8_structural_rules", "SELECT 'place_known' AS rule, count(*) FILTER (place_id IS NOT NULL) AS holds, bool_and(place_id IS NOT NULL) AS always FROM sx_calls UNION ALL SELECT 'hour_ok', count(*) FILTER (hour BETWEEN 0 AND 23), bool_and(hour BETWEEN 0 AND 23) FROM sx_calls UNION ALL SELECT 'small_place', count(*) FILTER (place_id < 10), coalesce(bool_and(coalesce(place_id < 10, FALSE)), FALSE) FROM sx_calls")
def _(t):
    return ql.structural_rules(t.sx_calls, {"place_known": F.col("place_id").isNotNull(), "hour_ok": F.col("hour").between(0, 23), "small_place": F.col("place_id") < 10})


@query("q9_missing_by", "SELECT lang AS \"by\", count(*) AS rows, 'quality' AS \"column\", 100 * avg((l.quality IS NULL)::INT::DOUBLE) AS missing_percent FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1", d="missing_percent")
def _(t):
    return ql.missing_by(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left"), ["quality"], "lang")


def _export(t):
    lat = F.when(F.col("o_orderkey") % 97 == 0, 99.0).otherwise(29.1)
    d = F.to_date("o_orderdate")
    text = F.date_format(F.when(F.col("o_orderkey") % 101 == 0, F.date_add(d, 1)).otherwise(d), "dd/MM/yyyy")
    return t.orders.select("o_orderkey", lat.alias("lat"), F.lit(-110.9).alias("lon"), d.cast("string").alias("date"), text.alias("date_text"), F.when(F.col("o_orderkey") % 89 == 0, 1900).otherwise(F.year(d)).alias("year"))


_XC = ["o_orderkey", "lat", "lon", "date", "date_text", "year"]


@query("q10_check_export", "SELECT 'lat' AS \"column\", 'in_range(28.0, 30.0)' AS rule, count(*)::BIGINT AS failing FROM orders WHERE o_orderkey % 97 = 0 UNION ALL SELECT 'date', 'dates_agree', count(*)::BIGINT FROM orders WHERE o_orderkey % 101 = 0")
def _(t):
    return ql.check_export(_export(t), _XC, "o_orderkey", "lat", "lon", "date", "date_text", "year", (28.0, 30.0, -112.0, -110.0))[0].drop("examples")


@query("q10_corrected_export", "SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders")
def _(t):
    return ql.check_export(_export(t), _XC, "o_orderkey", "lat", "lon", "date", "date_text", "year", (28.0, 30.0, -112.0, -110.0))[1].select("o_orderkey", "year")


@query("q11_distribution_report", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, quantile_cont({c}, 0.9) AS p90, quantile_cont({c}, 0.95) AS p95, quantile_cont({c}, 0.99) AS p99, max({c}) AS max FROM lineitem" for c in _NUM), d="mean std min p50 p75 p90 p95 p99 max")
def _(t):
    return ql.distribution_report(t.lineitem, _NUM)


@query("q12_quality_summary", "SELECT count(*) AS rows, 100 * avg((place_id IS NOT NULL)::INT::DOUBLE) AS located_percent, count(*) FILTER (NOT hour BETWEEN 2 AND 20) AS out_of_box, count(*) FILTER (year(date) <> 1996 + call_id % 2) AS year_differs, (SELECT sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM sx_calls GROUP BY place_id, date, kind)) AS repeated FROM sx_calls", d="located_percent")
def _(t):
    return ql.quality_summary(t.sx_calls, F.col("place_id").isNotNull(), F.col("hour").between(2, 20), F.year("date"), 1996 + F.col("call_id") % 2, [F.col("place_id"), F.col("date"), F.col("kind")])


@query("q13_lineage_table", None)
def _(t):
    files = io.file_digests(t.spark, f"{t.folder}/*.parquet")
    return ql.lineage_table(files, {name: f"synthetic {name}" for name in TABLES}).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length", "digest", "source")


@query("q14_hidden_missing", "SELECT CASE WHEN grouping(n_regionkey) = 1 THEN 'total' ELSE CAST(n_regionkey AS VARCHAR) END AS n_regionkey, count(*) AS rows, count(*) FILTER (n_nationkey IN (0, 5, 24)) AS hidden_n_nationkey, count(*) FILTER (n_name IN ('FRANCE', 'PERU')) AS hidden_n_name FROM nation GROUP BY CUBE (n_regionkey)")
def _(t):
    return ql.hidden_missing(t.nation, {"n_nationkey": [0, 5, 24], "n_name": ["FRANCE", "PERU"]}, "n_regionkey")


@query("q15_repeat_mentions", "WITH p AS (SELECT place_id, kind, count(*) AS c FROM sx_calls GROUP BY ALL) SELECT (SELECT sum(c)::BIGINT FROM p) AS rows, (SELECT sum(c - 1)::BIGINT FROM p) AS repeated, (SELECT count(DISTINCT coalesce(place_id, -1)) FROM p WHERE c > 1) AS posts_with_repeat, (SELECT count(*)::BIGINT FROM p) AS pairs, (SELECT sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM sx_calls GROUP BY place_id, kind, hour)) AS identical")
def _(t):
    return ql.repeat_mentions(t.sx_calls, "place_id", "kind", ["place_id", "kind", "hour"])
