"""Registration of queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.plans.views import Tables, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, d: str = ""):
    """Registers a function of Tables under `name`. Doubles (named in `d` for the oracle) are rounded to 6 places on
    both sides, as the order in which sums are made differs between engines."""

    def add(make: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = make(Tables(spark, folder))
            return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])

        QUERIES[name] = run
        if sql:
            rounded = ", ".join(f'round("{c}"::DOUBLE, 6) AS "{c}"' for c in d.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounded}) FROM ({duck(sql)})" if d else duck(sql)
        return make

    return add
