"""Tables that the queries run on, derived from the driver tables, in Spark SQL and in DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: DuckDB text of each view; Spark's differs in the spellings of SPELLINGS.
VIEWS = {
    "sx_rain": """SELECT d AS date, CASE WHEN h < 4 THEN CAST(10 + (n * 31) % 35 AS DOUBLE) WHEN h < 14 THEN CAST(1 + (n * 17) % 9 AS DOUBLE) ELSE 0.0E0 END AS mm
FROM (SELECT d, n, (n * 7919 + (n * n) % 9973) % 100 AS h FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS n FROM orders) a) b""",
    "sx_calls": """SELECT l_orderkey * 10 + l_linenumber AS call_id, CAST(l_shipdate AS DATE) AS date, CAST(l_orderkey % 24 AS INT) AS hour, concat(l_returnflag, l_linestatus) AS kind, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE s_nationkey END AS place_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "sx_places": """SELECT n_nationkey AS place_id, n_name AS place_name, CAST(1628000 + (n_nationkey % 5) * 1000 AS DOUBLE) AS x0, CAST(1918000 + (n_nationkey // 5) * 1000 AS DOUBLE) AS y0, CAST(1628000 + (n_nationkey % 5) * 1000 + 800 AS DOUBLE) AS x1, CAST(1918000 + (n_nationkey // 5) * 1000 + 800 AS DOUBLE) AS y1 FROM nation""",
    "sx_points": """SELECT c_custkey AS point_id, CAST(1627000 + (c_custkey * 7919) % 7000 AS DOUBLE) AS x, CAST(1917000 + (c_custkey * 6131) % 7000 AS DOUBLE) AS y FROM customer""",
    "sx_lines": """SELECT s_suppkey AS line_id, CAST(1627000 + (s_suppkey * 3571) % 7000 AS DOUBLE) AS xa, CAST(1917000 + (s_suppkey * 2221) % 7000 AS DOUBLE) AS ya, CAST(1627000 + (s_suppkey * 3571) % 7000 + CASE WHEN s_suppkey % 2 = 0 THEN 900 ELSE 0 END AS DOUBLE) AS xb, CAST(1917000 + (s_suppkey * 2221) % 7000 + CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 900 END AS DOUBLE) AS yb, CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE 1 END AS enabled, CASE WHEN s_suppkey % 10 = 0 THEN -1 ELSE CAST(1 + s_suppkey % 4 AS INT) END AS strahler FROM supplier""",
    "sx_notices": """SELECT doc_id AS post_id, source AS source_slug, TIMESTAMP '2024-01-01 19:30:00' + CAST(doc_id % 700 AS INT) * INTERVAL '1' DAY AS published_utc,
concat(CASE doc_id % 6 WHEN 0 THEN 'corte programado' WHEN 1 THEN 'atendemos una fuga' WHEN 2 THEN 'se envían pipas' WHEN 3 THEN 'concluyó la reparación de la fuga' WHEN 4 THEN 'el servicio se restablecerá; cierre programado' ELSE 'jornada de descuentos' END, ' de ', CAST(doc_id % 9 + 1 AS VARCHAR(3)), ' horas el ', CAST(doc_id % 30 + 1 AS VARCHAR(3)), ' de ', CASE doc_id % 3 WHEN 0 THEN 'enero' WHEN 1 THEN 'febrero' ELSE 'marzo' END, ' a partir de las ', CAST(doc_id % 12 + 1 AS VARCHAR(3)), ':00', CASE WHEN doc_id % 2 = 0 THEN 'am' ELSE 'pm' END, ' en la colonia ', CASE doc_id % 4 WHEN 0 THEN 'Misión del Arco' WHEN 1 THEN 'Villa Sol Norte' WHEN 2 THEN 'San Benito' ELSE 'Las Quintas' END, '. ', coalesce(text, '')) AS text,
CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'calle Rosales y Escobedo' ELSE concat('calle H', CAST(1 + doc_id % n AS VARCHAR(9)), ' y V', CAST(1 + (doc_id * 7) % n AS VARCHAR(9))) END AS ocr_text FROM documents CROSS JOIN (SELECT max(s_suppkey) AS n FROM supplier) k""",
    # a level street and a slanting one per supplier: each of one kind meets each of the other
    "sx_streets": """SELECT CASE WHEN s = 0 THEN concat('H', s_suppkey) ELSE concat('V', s_suppkey) END AS street, CAST(CASE WHEN s = 0 THEN 1626000 ELSE 1627000 + (s_suppkey * 37) % 7000 END AS DOUBLE) AS xa, CAST(CASE WHEN s = 0 THEN 1917000 + (s_suppkey * 61) % 7000 ELSE 1917000 END AS DOUBLE) AS ya, CAST(CASE WHEN s = 0 THEN 1636000 ELSE 1627700 + (s_suppkey * 37) % 7000 END AS DOUBLE) AS xb, CAST(CASE WHEN s = 0 THEN 1917000 + (s_suppkey * 61) % 7000 ELSE 1924000 END AS DOUBLE) AS yb FROM supplier CROSS JOIN (VALUES (0), (1)) v(s)
UNION ALL SELECT 'ROSALES', 1629000.0E0, 1919000.0E0, 1629000.0E0, 1919900.0E0 UNION ALL SELECT 'GENERAL MARIANO ESCOBEDO', 1628500.0E0, 1919400.0E0, 1629500.0E0, 1919400.0E0""",
}
SPELLINGS = (
    ("datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))", "datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01')"),
    ("n_nationkey // 5", "n_nationkey div 5"),
    ("TIMESTAMP '2024", "TIMESTAMP_NTZ '2024"),
    ("CAST(doc_id % 700 AS INT) * INTERVAL '1' DAY", "make_dt_interval(CAST(doc_id % 700 AS INT))"),
)
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


class Tables:
    """Driver tables and views of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            text = VIEWS[name]
            for duck, spark in SPELLINGS:
                text = text.replace(duck, spark)
            used = {t: getattr(self, t) for t in TABLES if f" {t}" in text}
            for t in used:
                text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
            return self.spark.sql(text, **{t: d for t, d in used.items() if f"{{{t}}}" in text})
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)


def duck(sql: str) -> str:
    """An oracle text with the views that it names put before it."""
    parts = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in sql]
    if not parts:
        return sql
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
