"""Queries of readers and writers: each writes what it reads back to the shared folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pluvia.operators import quality as ql
from pluvia.plans.catalog_tidy import years
from pluvia.plans.registry import query
from pluvia.sources import io
from pluvia.sources.rounds import scratch


@query("i1_union_exports", "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN NULL ELSE o_totalprice END AS o_totalprice, concat('y', year(o_orderdate)) AS source_slug FROM orders", d="o_totalprice")
def _(t):
    folder, paths = scratch(t.spark), []
    for y in years(t.orders, "o_orderdate"):
        rows = t.orders.where(F.year("o_orderdate") == y).select("o_totalprice", "o_orderstatus", "o_orderkey")
        paths.append(f"{folder}/export_y{y}")
        (rows.drop("o_totalprice") if y == 1997 else rows).write.option("header", True).csv(paths[-1])
    return io.union_exports(t.spark, paths, {"o_orderkey": "bigint", "o_totalprice": "double"}, "o_orderkey", "export_(y[0-9]+)")


@query("i7_read_typed", "SELECT o_orderkey, o_orderdate::DATE AS day, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS code, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS note FROM orders")
def _(t):
    path = f"{scratch(t.spark)}/typed"
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("code"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("note"))
    rows.write.option("header", True).csv(path)
    return io.read_typed(t.spark, path, "o_orderkey bigint, day date, code bigint, note string", dates=["day"], text_keys=["code"], empty_text=["note"])


@query("i8_write_policy", "SELECT 'skip' AS policy, count(*) AS n FROM orders UNION ALL SELECT 'overwrite', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'error', count(*) FROM orders")
def _(t):
    parts = []
    for policy in ("skip", "overwrite", "error"):
        path = f"{scratch(t.spark)}/policy"
        io.write_policy(t.orders, path, "error")
        try:
            io.write_policy(t.orders.where("o_orderstatus = 'F'"), path, policy)
        except AnalysisException:
            if policy != "error":
                raise
        parts.append(t.spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(policy).alias("policy"), "n"))
    return io.union_sheets(parts)


@query("i9_refresh_partitions", "SELECT year(o_orderdate)::INT AS year, count(*) AS n, sum(CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 2 ELSE 1 END)::BIGINT AS marks FROM orders GROUP BY 1")
def _(t):
    path, known = f"{scratch(t.spark)}/years", years(t.orders, "o_orderdate")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    io.refresh_partitions(rows.withColumn("mark", F.lit(1)), path, "year", known)
    io.refresh_partitions(rows.withColumn("mark", F.lit(2)), path, "year", known[-1:])
    return t.spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"), F.sum("mark").alias("marks"))


@query("i10_write_validated", "SELECT call_id, hour FROM sx_calls WHERE place_id IS NOT NULL")
def _(t):
    path = f"{scratch(t.spark)}/validated"
    io.write_validated(t.sx_calls.where("place_id is not null").select("call_id", "hour"), lambda df: ql.validate(df, [ql.in_range("hour", 0, 23), ql.not_null("call_id")]), path)
    return t.spark.read.parquet(path)
