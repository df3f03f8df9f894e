"""Queries of reading, cleaning, resolution and text, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvia.functions import text as tx
from pluvia.operators import resolve as rs
from pluvia.operators import tidy
from pluvia.plans.registry import query
from pluvia.sources import io

NORM = "trim(regexp_replace(regexp_replace(upper(strip_accents(replace(coalesce({}, ''), 'ß', 'ss'))), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


def years(df, date):
    """The years of a table, as a reader of yearly files would list them."""
    return sorted(r[0] for r in df.select(F.year(date)).distinct().collect())


@query("i2_union_partitions", """
SELECT p_partkey, price, date, year, strftime(date, '%d/%m/%Y') AS date_text, row_number() OVER (ORDER BY year, p_partkey)::BIGINT AS row_id FROM (
SELECT o_orderkey AS p_partkey, o_totalprice AS price, o_orderdate::DATE AS date, year(o_orderdate)::INT AS year FROM orders)""", d="price")
def _(t):
    def one(y):
        return t.orders.where(F.year("o_orderdate") == y).select(F.col("o_orderkey").alias("p_partkey"), F.col("o_totalprice").cast("string").alias("price"), F.lit("x").alias("lon"), F.to_date("o_orderdate").cast("string").alias("date"))

    return io.union_partitions({y: one(y) for y in years(t.orders, "o_orderdate")}, "year", "p_partkey", "price", "lon", "date").drop("lon")


@query("i3_explode_parallel", "SELECT date, mm FROM sx_rain", d="mm")
def _(t):
    by_month = t.sx_rain.groupBy(F.trunc("date", "month").alias("m")).agg(F.sort_array(F.collect_list(F.struct("date", "mm"))).alias("l"))
    nested = by_month.select("m", F.struct(F.col("l.date").alias("date"), F.col("l.mm").alias("mm")).alias("daily"))
    return io.explode_parallel(nested, "daily", ["date", "mm"]).select("date", "mm")


@query("i4_union_sheets", "SELECT call_id, kind FROM sx_calls")
def _(t):
    return io.union_sheets([t.sx_calls.where(F.year("date") == y).select("call_id", "kind") for y in years(t.sx_calls, "date")])


@query("i5_union_layers", "SELECT line_id, CASE WHEN line_id % 2 = 0 THEN 'east' ELSE 'west' END AS origin FROM sx_lines")
def _(t):
    return io.union_layers({n: t.sx_lines.where(F.col("line_id") % 2 == k).select("line_id") for k, n in enumerate(("east", "west"))})


@query("i6_select_layer", "SELECT point_id, x, y FROM sx_points WHERE x > 1630000", d="x y")
def _(t):
    return io.select_layer(t.sx_points.withColumn("layer", F.lit("ha")), "ha", ["point_id", "x", "y"], F.col("x") > 1630000)


@query("i11_manifest_diff", """
SELECT path, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'unexpected' ELSE 'changed' END AS kind FROM (
SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS a FROM documents WHERE doc_id % 10 <> 3) FULL JOIN (SELECT CAST(doc_id AS VARCHAR) AS path, sha256(CASE WHEN doc_id % 7 = 2 THEN 'x' ELSE text END) AS b FROM documents WHERE doc_id % 11 <> 4) USING (path) WHERE a IS DISTINCT FROM b""")
def _(t):
    d = t.documents.select(F.col("doc_id").cast("string").alias("path"), "doc_id", "text")
    a = d.where("doc_id % 10 <> 3").select("path", F.sha2("text", 256).alias("digest"))
    b = d.where("doc_id % 11 <> 4").select("path", F.sha2(F.when(F.col("doc_id") % 7 == 2, "x").otherwise(F.col("text")), 256).alias("digest"))
    return io.manifest_diff(a, b)


_PLAN = """SELECT page_id, url, CASE WHEN u IS NOT NULL THEN concat(page_id, CASE WHEN e = '' THEN '.jpg' ELSE lower(e) END) END AS file,
CASE WHEN u IS NULL THEN 'empty_url' WHEN page_id % 3 = 0 THEN 'existing' ELSE 'pending' END AS status
FROM (SELECT page_id, CASE WHEN page_id % 5 = 1 THEN '' ELSE url END AS url, CASE WHEN page_id % 5 = 1 THEN NULL ELSE url END AS u, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '([.][A-Za-z0-9]{1,5})$', 1) AS e FROM pages)"""


def _downloads(t):
    pages = t.pages.select("page_id", F.when(F.col("page_id") % 5 == 1, "").otherwise(F.col("url")).alias("url"))
    names = io.plan_downloads(t.pages.select("page_id", "url"), "url", "page_id", t.pages.select(F.lit("none").alias("file")))
    return io.plan_downloads(pages, "url", "page_id", names.where("page_id % 3 = 0").select("file"))


@query("i12_plan_downloads", _PLAN)
def _(t):
    return _downloads(t)


@query("i14_status_counts", f"SELECT s.status, count(p.page_id) AS n FROM (VALUES ('existing'), ('pending'), ('empty_url'), ('failed')) s(status) LEFT JOIN ({_PLAN}) p ON p.status = s.status GROUP BY 1")
def _(t):
    return io.status_counts(_downloads(t), "status", ["existing", "pending", "empty_url", "failed"])


@query("i13_attach_external_text", "SELECT d.doc_id, l.toxic::INT AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    parts = [t.labels.where(F.col("doc_id") % 2 == k).select("doc_id", "toxic") for k in (0, 1)]
    return io.attach_external_text(t.documents.select("doc_id"), parts, "doc_id", {"toxic": "status"})


@query("i15_card_fields", """
SELECT p_partkey, p_type AS material, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS street, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS neighborhood FROM part""")
def _(t):
    html = F.concat(F.lit('<div><p class="card-text"><b>'), F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat("p_name", F.lit(", "), "p_brand")), F.lit("</b><br>Material: "), "p_type", F.lit("</p></div>"))
    return io.card_fields(t.part.select("p_partkey", html.alias("html")), "html")


_GROUPS = "(SELECT kind, CASE WHEN kind IN ('RF', 'AF') THEN 'cerrado' ELSE 'abierto' END AS grupo FROM (SELECT DISTINCT kind FROM sx_calls))"


def _groups(t):
    return t.sx_calls.select("kind").distinct().withColumn("grupo", F.when(F.col("kind").isin("RF", "AF"), "cerrado").otherwise("abierto"))


@query("f1_clean_calls", f"SELECT call_id, date, hour AS hora, kind AS tipo, place_id, grupo FROM sx_calls JOIN {_GROUPS} g USING (kind) WHERE place_id IS NOT NULL AND kind IN ('RF', 'NO')")
def _(t):
    return tidy.clean_calls(t.sx_calls, "kind", ["RF", "NO"], {"hour": "hora", "kind": "tipo"}, _groups(t), "grupo", ["hora"])


@query("f2_unify_codes", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'ALTA' WHEN '2-HIGH' THEN 'ALTA' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def _(t):
    variants = t.spark.createDataFrame([("1-URGENT", "ALTA"), ("2-HIGH", "ALTA")], "variant string, canonical string")
    return tidy.unify_codes(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", variants)


@query("f3_derive_group", f"SELECT call_id, kind, grupo FROM sx_calls LEFT JOIN {_GROUPS} g USING (kind)")
def _(t):
    return tidy.derive_group(t.sx_calls.select("call_id", "kind"), "kind", _groups(t), "grupo")


@query("f4_drop_all_blank", "SELECT doc_id, nullif(trim(a), '') AS a, nullif(trim(b), '') AS b FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE lang END AS a, CASE WHEN doc_id % 2 = 0 THEN '' ELSE source END AS b FROM documents) WHERE trim(a) <> '' OR trim(b) <> ''")
def _(t):
    d = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("lang")).alias("a"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source")).alias("b"))
    return tidy.drop_all_blank(d, ["a", "b"])


@query("f5_project_final", "SELECT n_nationkey::BIGINT AS n_nationkey, NULL::VARCHAR AS note, n_name FROM nation")
def _(t):
    return tidy.project_final(t.nation, {"n_nationkey": "bigint", "note": "string", "n_name": "string"})


@query("f6_exclude_group", "SELECT call_id, place_id FROM sx_calls WHERE place_id IS DISTINCT FROM 3")
def _(t):
    return tidy.exclude_group(t.sx_calls.select("call_id", "place_id"), "place_id", 3)


@query("f7_filter_city", "SELECT doc_id FROM documents WHERE lang = 'en' AND source = 'src1'")
def _(t):
    return tidy.filter_city(t.documents.select("doc_id", "lang", "source"), "lang", "en", "source", "src1").select("doc_id")


@query("f8_in_bounds", "SELECT point_id, (y BETWEEN 1918000 AND 1921000 AND x BETWEEN 1628000 AND 1632000) AS in_box FROM sx_points")
def _(t):
    return tidy.in_bounds(t.sx_points, "y", "x", (1918000.0, 1921000.0, 1628000.0, 1632000.0)).select("point_id", "in_box")


@query("f9_null_outside", "SELECT call_id, CASE WHEN place_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) THEN place_id END AS place_id FROM sx_calls")
def _(t):
    return tidy.null_outside(t.sx_calls.select("call_id", "place_id"), "place_id", t.nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("place_id"))).select("call_id", "place_id")


@query("f10_counts_from_sparse", "SELECT doc_id, coalesce(q, 0)::BIGINT AS q, coalesce(x, 0)::BIGINT AS x, (coalesce(q, 0) + coalesce(x, 0))::BIGINT AS total, coalesce(x, 0) / nullif(coalesce(q, 0) + coalesce(x, 0), 0)::DOUBLE AS share FROM documents LEFT JOIN (SELECT doc_id, quality AS q, toxic AS x FROM labels) USING (doc_id)", d="share")
def _(t):
    df = t.documents.select("doc_id").join(t.labels.select("doc_id", F.col("quality").alias("q"), F.col("toxic").alias("x")), "doc_id", "left")
    return tidy.counts_from_sparse(df, ["q", "x"], "x")


@query("f11_presence_flags", "SELECT post_id, coalesce(ocr_text, '') AS ocr_text, ocr_text IS NOT NULL AS has_ocr_text FROM sx_notices")
def _(t):
    return tidy.presence_flags(t.sx_notices.select("post_id", "ocr_text"), ["ocr_text"])


@query("f12_log1p_scale", "SELECT o_orderkey, (ln(1 + o_totalprice) - avg(ln(1 + o_totalprice)) OVER ()) / stddev_pop(ln(1 + o_totalprice)) OVER () AS o_totalprice_z FROM orders", d="o_totalprice_z")
def _(t):
    return tidy.log1p_scale(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice"]).drop("o_totalprice")


@query("f13_cyclic_encode", "SELECT call_id, hour, sin(hour * (2 * pi() / 24)) AS hour_sin, cos(hour * (2 * pi() / 24)) AS hour_cos FROM sx_calls", d="hour_sin hour_cos")
def _(t):
    return tidy.cyclic_encode(t.sx_calls.select("call_id", "hour"), "hour", 24)


@query("f14_cut_right_closed", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 5 THEN NULL WHEN l_quantity <= 20 THEN 'bajo' WHEN l_quantity <= 45 THEN 'medio' END AS bin FROM lineitem")
def _(t):
    return tidy.bin_right_closed(t.lineitem, "l_quantity", (5.0, 20.0, 45.0), ("bajo", "medio")).select("l_orderkey", "l_linenumber", "bin")


@query("f15_qcut", "WITH e AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders) SELECT o_orderkey, ((o_totalprice > e[1])::INT + (o_totalprice > e[2])::INT + (o_totalprice > e[3])::INT + (o_totalprice > e[4])::INT)::INT AS bin FROM orders CROSS JOIN e")
def _(t):
    return tidy.qcut(t.orders, "o_totalprice", 5).select("o_orderkey", "bin")


@query("f16_exposure_class", """
SELECT class, count(*) AS n FROM (SELECT CASE WHEN e AND n > 0 THEN 'con exposición, con eventos' WHEN e THEN 'con exposición, sin eventos' WHEN n > 0 THEN 'sin exposición, con eventos' ELSE 'sin exposición, sin eventos' END AS class
FROM (SELECT c_custkey, c_acctbal > 5000 AS e, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 GROUP BY 1) USING (c_custkey))) GROUP BY 1""")
def _(t):
    hit = t.orders.where("o_orderstatus = 'F' AND o_totalprice > 250000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    out = tidy.exposure_class(t.customer.select("c_custkey", (F.col("c_acctbal") > 5000).alias("e")), "c_custkey", "e", hit)
    return out.groupBy("class").agg(F.count("*").alias("n"))


@query("k1_join_left", "SELECT call_id, n_name FROM sx_calls LEFT JOIN nation ON place_id = n_nationkey")
def _(t):
    return rs.join_left(t.sx_calls.select("call_id", "place_id"), t.nation.select(F.col("n_nationkey").alias("place_id"), "n_name"), "place_id").select("call_id", "n_name")


_BIG = "(SELECT o_orderkey FROM orders WHERE o_totalprice > 200000)"


@query("k2_semi_join", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN {_BIG}")
def _(t):
    return rs.semi_join(t.lineitem.select("l_orderkey", "l_linenumber"), t.orders.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query("k2_anti_join", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN {_BIG}")
def _(t):
    return rs.anti_join(t.lineitem.select("l_orderkey", "l_linenumber"), t.orders.where("o_totalprice > 200000").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query("k3_outer_add", "SELECT place_id, (coalesce(a.n, 0) + coalesce(b.n, 0))::BIGINT AS n FROM (SELECT s_nationkey AS place_id, count(*) AS n FROM supplier GROUP BY 1) a FULL JOIN (SELECT c_nationkey AS place_id, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) b USING (place_id)")
def _(t):
    count = lambda df, c: df.groupBy(F.col(c).alias("place_id")).agg(F.count("*").alias("n"))
    return rs.outer_add(count(t.supplier, "s_nationkey"), count(t.customer.where("c_acctbal > 9000"), "c_nationkey"), "place_id")


@query("k4_repeated_keys", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return rs.repeated_keys(t.lineitem, ["l_orderkey"])


@query("k5_join_validated", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    return rs.join_validated(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), t.customer.select("c_custkey", "c_mktsegment"), "c_custkey").select("o_orderkey", "c_mktsegment")


@query("k6_unambiguous_catalog", "SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1")
def _(t):
    return rs.unambiguous_catalog(t.part, "p_name", "p_partkey")


_NAMES = "(SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN concat('  ', n_name, '.') WHEN 2 THEN concat('viejo ', n_name) ELSE 'nada' END AS raw FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_CAT = f"(SELECT {NORM.format('n_name')} AS k, min(n_nationkey) AS id FROM nation GROUP BY 1 HAVING count(DISTINCT n_nationkey) = 1)"


def _names(t):
    df = t.customer.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.lower("n_name")).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("  "), "n_name", F.lit("."))).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("viejo "), "n_name")).otherwise("nada")
    return df.select("c_custkey", raw.alias("raw"))


def _cat(t):
    return t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))


@query("k7_resolve_by_name", f"SELECT c_custkey, id, CASE WHEN id IS NOT NULL THEN 'catalogo' END AS id_source FROM {_NAMES} n LEFT JOIN {_CAT} c ON {NORM.format('raw')} = k")
def _(t):
    return rs.resolve_by_name(_names(t), "raw", _cat(t), "name", "id").select("c_custkey", "id", "id_source")


@query("k8_resolve_by_alias", f"SELECT c_custkey, coalesce(c.id, a.id) AS id, CASE WHEN c.id IS NOT NULL THEN 'catalogo' WHEN a.id IS NOT NULL THEN 'equivalencia' END AS id_source FROM {_NAMES} n LEFT JOIN {_CAT} c ON {NORM.format('raw')} = c.k LEFT JOIN (SELECT concat('VIEJO ', k) AS k, id FROM {_CAT} WHERE id % 2 = 0) a ON {NORM.format('raw')} = a.k")
def _(t):
    aliases = t.nation.select(F.concat(F.lit("Viejo "), "n_name").alias("alias"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("NA").alias("target"))
    named = rs.resolve_by_name(_names(t), "raw", _cat(t), "name", "id")
    return rs.resolve_by_alias(named, "raw", aliases, "alias", "target", _cat(t), "name", "id").select("c_custkey", "id", "id_source")


@query("k9_resolve_fuzzy", None)
def _(t):
    typos = t.part.select(F.concat(F.substring("p_name", 1, 6), F.lit("x"), F.substring("p_name", 7, 100)).alias("raw"))
    return rs.resolve_fuzzy(typos, "raw", t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id")), "name", "id")


@query("k9_resolve_fuzzy_levenshtein", f"""
WITH n AS (SELECT DISTINCT raw, {NORM.format('raw')} AS k FROM (SELECT concat(substr(n_name, 1, 3), 'X', substr(n_name, 4)) AS raw FROM nation)), c AS {_CAT},
s AS (SELECT raw, c.k, id, 1 - levenshtein(n.k, c.k) / greatest(length(n.k), length(c.k))::DOUBLE AS score FROM n, c WHERE n.k NOT IN (SELECT k FROM c)),
r AS (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY score DESC, k) AS r, lead(score) OVER (PARTITION BY raw ORDER BY score DESC, k) AS nxt FROM s WHERE score >= 0.7),
g AS (SELECT * FROM r WHERE r = 1 AND (nxt IS NULL OR score - nxt >= 0.05))
SELECT n.raw, g.id, CASE WHEN g.id IS NOT NULL THEN 'similarity' END AS method, g.score FROM n LEFT JOIN g ON n.raw = g.raw""", d="score")
def _(t):
    typos = t.nation.select(F.concat(F.substring("n_name", 1, 3), F.lit("X"), F.substring("n_name", 4, 100)).alias("raw"))
    return rs.resolve_fuzzy(typos, "raw", _cat(t), "name", "id", threshold=0.7, mode="levenshtein")


@query("k10_resolve_prefix", """
WITH n AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS w FROM part), c AS (SELECT DISTINCT array_to_string(list_slice(string_split(p_name, ' '), 1, 1 + (p_partkey % 2)::INT), ' ') AS prefix FROM part)
SELECT p_partkey, max_by(prefix, length(prefix)) AS prefix FROM n LEFT JOIN c ON length(prefix) >= 5 AND (p_name = prefix OR starts_with(p_name, concat(prefix, ' '))) GROUP BY 1""")
def _(t):
    cat = t.part.select(F.expr("array_join(slice(split(p_name, ' '), 1, cast(1 + p_partkey % 2 as int)), ' ')").alias("prefix"))
    return rs.resolve_prefix(t.part.select("p_partkey", "p_name"), "p_name", cat, "prefix").select("p_partkey", "prefix")


_LISTS = "(SELECT o_orderkey, concat('[', o_custkey % 30, ',', o_orderkey % 30, ',', o_custkey % 30, ']') AS ids FROM orders)"


def _lists(t):
    return t.orders.select("o_orderkey", F.concat(F.lit("["), F.col("o_custkey") % 30, F.lit(","), F.col("o_orderkey") % 30, F.lit(","), F.col("o_custkey") % 30, F.lit("]")).alias("ids"))


@query("k11_explode_lookup_concat", """
SELECT o_orderkey, CASE WHEN a.n_name IS NOT NULL AND b.n_name IS NOT NULL AND a.n_name <> b.n_name THEN concat(a.n_name, ', ', b.n_name) ELSE coalesce(a.n_name, b.n_name) END AS names
FROM orders LEFT JOIN nation a ON a.n_nationkey = o_custkey % 30 LEFT JOIN nation b ON b.n_nationkey = o_orderkey % 30""")
def _(t):
    return rs.explode_lookup_concat(_lists(t), "o_orderkey", "ids", t.nation.select(F.col("n_nationkey").cast("long").alias("id"), "n_name"), "id", "n_name")


@query("k12_distinct_list_ids", "SELECT DISTINCT unnest([o_custkey % 30, o_orderkey % 30])::BIGINT AS id FROM orders")
def _(t):
    return rs.distinct_list_ids(_lists(t), "ids")


@query("k13_coalesce_provenance", "SELECT doc_id, coalesce(a, b, c) AS v, CASE WHEN a IS NOT NULL THEN 'original' WHEN b IS NOT NULL THEN 'within' WHEN c IS NOT NULL THEN 'nearest' END AS source FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang END AS a, CASE WHEN doc_id % 5 = 0 THEN source END AS b, CASE WHEN doc_id % 2 = 0 THEN 'x' END AS c FROM documents)")
def _(t):
    d = t.documents.select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN lang END").alias("a"), F.expr("CASE WHEN doc_id % 5 = 0 THEN source END").alias("b"), F.expr("CASE WHEN doc_id % 2 = 0 THEN 'x' END").alias("c"))
    return rs.coalesce_provenance(d, [("a", "original"), ("b", "within"), ("c", "nearest")], "v", "source").select("doc_id", "v", "source")


@query("k14_resolve_with_fallback", f"""
SELECT c_custkey, coalesce(CAST(a.id AS VARCHAR), CASE WHEN g BETWEEN 0 AND 24 THEN CAST(g AS VARCHAR) END, CAST(b.id AS VARCHAR), '0') AS id
FROM (SELECT n.*, c_custkey % 60 AS g, concat('nombre', c_custkey % 9) AS gn FROM {_NAMES} n) LEFT JOIN {_CAT} a ON {NORM.format('raw')} = a.k LEFT JOIN {_CAT} b ON {NORM.format('gn')} = b.k""")
def _(t):
    df = _names(t).withColumn("g", F.col("c_custkey") % 60).withColumn("gn", F.concat(F.lit("nombre"), F.col("c_custkey") % 9))
    return rs.resolve_with_fallback(df, "raw", "g", "gn", _cat(t), "name", "id").select("c_custkey", "id")


@query("k15_compare_sources", f"""
SELECT count(*) AS rows, count(m) AS comparable, count(*) FILTER (m) AS equal, count(*) FILTER (NOT m) AS different, count(*) FILTER (m) * 100.0::DOUBLE / count(m) AS percent
FROM (SELECT CASE WHEN raw IS NOT NULL AND b IS NOT NULL THEN {NORM.format('raw')} = {NORM.format('b')} END AS m FROM (SELECT n.raw, CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS b FROM {_NAMES} n JOIN customer USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey))""", d="percent")
def _(t):
    df = _names(t).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey").join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    both = rs.compare_sources(df.withColumn("b", F.when(F.col("c_custkey") % 7 != 0, F.col("n_name"))), "raw", "b")
    return rs.agreement(both, F.col("match"))


@query("k16_duplicated_names", "SELECT p_partkey, p_name, occurrences FROM (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS occurrences FROM part) WHERE occurrences > 1")
def _(t):
    return rs.duplicated_names(t.part.select("p_partkey", "p_name"), "p_name")


@query("k17_sector_lookup", f"SELECT name, min(sector) AS sector FROM (SELECT {NORM.format('unnest(string_split(l, chr(59)))')} AS name, sector FROM (SELECT concat(n_name, ';', 'Común', ';', ' ') AS l, n_regionkey AS sector FROM nation)) WHERE name <> '' GROUP BY 1 HAVING count(DISTINCT sector) = 1")
def _(t):
    return rs.sector_lookup(t.nation.select(F.concat("n_name", F.lit(";Común; ")).alias("l"), F.col("n_regionkey").alias("sector")), "l", "sector")


@query("t1_normalize_name", f"SELECT doc_id, {NORM.format('text')} AS name FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.normalize_name(F.col("text")).alias("name"))


@query("t2_normalize_settlement", """
SELECT post_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(upper(trim(s))), '^(COLONIA|COL\\.?|FRACCIONAMIENTO|FRACC\\.?)\\s+', ''), '[^A-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '') AS name
FROM (SELECT post_id, CASE post_id % 4 WHEN 0 THEN concat('Col. ', source_slug, ' ñ') WHEN 1 THEN concat('fraccionamiento ', source_slug) WHEN 2 THEN ' . ' ELSE source_slug END AS s FROM sx_notices)""")
def _(t):
    s = F.expr("CASE post_id % 4 WHEN 0 THEN concat('Col. ', source_slug, ' ñ') WHEN 1 THEN concat('fraccionamiento ', source_slug) WHEN 2 THEN ' . ' ELSE source_slug END")
    return t.sx_notices.select("post_id", tx.normalize_settlement(s).alias("name"))


_RULES = "CASE " + " ".join(f"WHEN regexp_matches(h, '{p}') THEN '{n}'" for n, p in reversed(tx.EVENT_RULES)) + " ELSE 'otro' END"


@query("t3_classify_rules", f"SELECT post_id, {_RULES} AS event_type FROM (SELECT post_id, regexp_replace(text, '{tx.FUTURE_RESTORE}', ' ', 'g') AS h FROM sx_notices)")
def _(t):
    return t.sx_notices.select("post_id", tx.classify_rules(F.col("text")).alias("event_type"))


@query("t4_parse_duration_hours", f"SELECT post_id, try_cast(nullif(regexp_extract(text, '{tx.DURATION}', 1), '') AS DOUBLE) AS hours FROM sx_notices", d="hours")
def _(t):
    return t.sx_notices.select("post_id", tx.parse_duration_hours(F.col("text")).alias("hours"))


@query("t5_parse_start", f"""
WITH p AS (SELECT post_id, published_utc AS pub, regexp_extract(text, '{tx.DATE}', 1)::INT AS d, list_position([{", ".join(f"'{m}'" for m in tx.MONTHS)}], regexp_extract(text, '{tx.DATE}', 2)) AS m,
regexp_extract(text, '{tx.START_TIME}', 1)::INT AS h, regexp_extract(text, '{tx.START_TIME}', 2)::INT AS mi, regexp_extract(text, '{tx.START_TIME}', 3) AS ap FROM sx_notices),
c AS (SELECT post_id, pub, try_cast(printf('%04d-%02d-%02d %02d:%02d:00', year(pub) + k, m, d, CASE WHEN ap = 'pm' AND h < 12 THEN h + 12 ELSE h END, mi) AS TIMESTAMP) AS s FROM p CROSS JOIN (VALUES (-1), (0), (1)) v(k)),
b AS (SELECT post_id, s, abs(epoch(s) - epoch(pub)) AS far FROM c WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY abs(epoch(s) - epoch(pub)), s) = 1)
SELECT n.post_id, CASE WHEN far <= 30 * 86400 THEN s END AS start_at FROM sx_notices n LEFT JOIN b USING (post_id)""")
def _(t):
    return t.sx_notices.select("post_id", tx.parse_start(F.col("text"), F.col("published_utc")).alias("start_at"))


@query("t6_local_time_features", "SELECT post_id, l AS published_at, year(l)::INT AS year, month(l)::INT AS month, weekofyear(l)::INT AS iso_week, (isodow(l) - 1)::INT AS day_of_week, hour(l)::INT AS hour_of_day FROM (SELECT post_id, published_utc - INTERVAL 7 HOUR AS l FROM sx_notices)")
def _(t):
    return tx.local_time_features(t.sx_notices.select("post_id", "published_utc"), "published_utc").drop("published_utc")


def _settlements(t):
    return t.spark.createDataFrame([(1, "MISION DEL ARCO"), (2, "VILLA SOL"), (3, "VILLA SOL NORTE"), (4, "SAN BENITO"), (5, "LAS QUINTAS"), (6, "ROSALES")], "id int, name string")


MENTIONS = "SELECT post_id, 'colonia' AS location_type, raw_text, id::INT AS id, 'texto' AS source_field, 'colonia_con_marcador' AS match_method FROM (SELECT post_id, CASE post_id % 4 WHEN 0 THEN 'MISION DEL ARCO' WHEN 1 THEN 'VILLA SOL' WHEN 2 THEN 'SAN BENITO' ELSE 'LAS QUINTAS' END AS raw_text, CASE post_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 5 END AS id FROM sx_notices)"


@query("t7_dictionary_mentions", MENTIONS)
def mentions(t):
    return tx.dictionary_mentions(t.sx_notices, "post_id", {"text": "texto", "ocr_text": "ocr"}, _settlements(t), "name", "id")


@query("t8_extract_crossings", "SELECT post_id, substr(ocr_text, 7) AS expression, 'ocr' AS source_field FROM sx_notices WHERE ocr_text IS NOT NULL")
def crossings(t):
    return tx.extract_crossings(t.sx_notices, "post_id", {"text": "texto", "ocr_text": "ocr"})


_EXPR = "CASE p_partkey % 4 WHEN 0 THEN concat(p_name, ' entre ', p_brand, ' y ', p_type) WHEN 1 THEN concat(p_name, ' ENTRE ', p_brand) WHEN 2 THEN concat(p_name, ' y ', p_brand) ELSE p_name END"


@query("t9_parse_crossing", f"""SELECT p_partkey, CASE WHEN regexp_matches(e, '(?i)^.+? entre .+? y .+$') THEN concat(regexp_extract(e, '(?i)^(.+?) entre (.+?) y (.+)$', 1), '|', regexp_extract(e, '(?i)^(.+?) entre (.+?) y (.+)$', 2), '|', regexp_extract(e, '(?i)^(.+?) entre (.+?) y (.+)$', 3))
WHEN regexp_matches(e, '(?i)^.+? entre .+$') THEN concat(regexp_extract(e, '(?i)^(.+?) entre (.+)$', 1), '|', regexp_extract(e, '(?i)^(.+?) entre (.+)$', 2)) WHEN regexp_matches(e, '(?i)^.+? y .+$') THEN concat(regexp_extract(e, '(?i)^(.+?) y (.+)$', 1), '|', regexp_extract(e, '(?i)^(.+?) y (.+)$', 2)) END AS streets FROM (SELECT p_partkey, {_EXPR} AS e FROM part)""")
def _(t):
    return t.part.select("p_partkey", F.array_join(tx.parse_crossing(F.expr(_EXPR)), "|").alias("streets"))


@query("t10_street_candidates", f"""
WITH k AS (SELECT DISTINCT {NORM.format('p_name')} AS street FROM part), n AS (SELECT DISTINCT concat('calle ', p_name, ' sur') AS name, {NORM.format('p_name')} AS k FROM part),
p AS (SELECT name, n AS cut, array_to_string(list_slice(string_split(concat(k, ' SUR'), ' '), 1, n), ' ') AS g FROM n CROSS JOIN (SELECT unnest(range(1, 12)) AS n) WHERE n <= len(string_split(concat(k, ' SUR'), ' '))),
h AS (SELECT name, cut, street FROM p JOIN k ON contains(concat(' ', street, ' '), concat(' ', g, ' '))) SELECT name, street FROM h WHERE cut = (SELECT max(cut) FROM h h2 WHERE h2.name = h.name)""")
def _(t):
    streets = t.part.select(tx.normalize_name(F.col("p_name")).alias("street"))
    names = t.part.select(F.concat(F.lit("calle "), "p_name", F.lit(" sur")).alias("name"))
    return tx.street_candidates(names, "name", streets, "street", fuzzy=False)


@query("t10_street_candidates_fuzzy", None)
def _(t):
    streets = t.part.select(tx.normalize_name(F.col("p_name")).alias("street"))
    names = t.part.select(F.regexp_replace("p_name", "[aeiou]([^aeiou]*)$", "x$1").alias("name"))
    return tx.street_candidates(names, "name", streets, "street")


@query("t12_split_bullets", "SELECT doc_id, l AS line FROM (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^[ •·▪\\-\\t\\r]+|[ •·▪\\-\\t\\r]+$', '', 'g') AS l FROM documents) WHERE l <> '' AND NOT ends_with(l, ':') AND NOT contains(l, 'www.')")
def _(t):
    return tx.split_bullets(t.documents.select("doc_id", "text"), "text").select("doc_id", "line")


@query("t13_keyword_rate", "SELECT lang AS period, count(*) AS n, avg(regexp_matches(text, 'idiot|clown')::INT::DOUBLE) * 100 AS percent FROM documents GROUP BY 1", d="percent")
def _(t):
    return tx.keyword_rate(t.documents, "text", "idiot|clown", F.col("lang"))


@query("t14_text_length_features", "SELECT post_id, length(text)::INT AS n_chars_text, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '))::INT AS n_words FROM sx_notices")
def _(t):
    return tx.text_length_features(t.sx_notices.select("post_id", "text"), "text").select("post_id", "n_chars_text", "n_words")


@query("t15_tfidf", """
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{2,}') AS t FROM documents), u AS (SELECT doc_id, unnest(t) AS term FROM t UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: concat(t[i], ' ', t[i + 1]))) FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM u GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 5 AND count(*) <= 0.5 * (SELECT count(*) FROM documents)),
w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (term)) SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w""", d="weight")
def _(t):
    return tx.tfidf(t.documents, "doc_id", "text")


@query("t16_truncated_svd", None)
def _(t):
    return tx.truncated_svd(tx.tfidf(t.documents, "doc_id", "text"), "doc_id", "term", "weight", 50)
