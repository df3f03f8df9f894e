"""What the operators of this subpackage share: saved tables, prefix sums and bounded broadcasts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tables of at most this many rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. Where it is unset a local master gets a temporary one; on a cluster that is
    an error, as each executor would write to its own disk."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="pluvia-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/pluvia/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as Parquet in the shared folder and read again; lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows, else unchanged. df should be saved already."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ids_for_python(df: DataFrame, col: str = "id") -> DataFrame:
    """Adds <col>_none and puts 0 for null in a column of longs. In pandas a column with nulls turns to doubles, which hold no more than 53 bits."""
    null = F.col(col).isNull() if df.schema[col].dataType.simpleString() == "bigint" else F.lit(False)
    return df.withColumn(f"{col}_none", null).withColumn(col, F.when(null, F.lit(0).cast("long")).otherwise(F.col(col)) if df.schema[col].dataType.simpleString() == "bigint" else F.col(col))


def ids_from_python(df: DataFrame, col: str = "id") -> DataFrame:
    """Null again where <col>_none says so."""
    return df.withColumn(col, F.when(~F.col(f"{col}_none"), F.col(col))).drop(f"{col}_none")


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, which gives freed memory back to the system when a task ends: Python workers stay
    alive between tasks and stages, and what they keep adds up with the JVM's heap."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over all rows before the row in `order`, exclusive.

    Rows are dealt by range, each partition is summed on its own, and only one number per partition goes
    to the driver. Rows that tie in the whole order share a partition, so give an order without large ties.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order])
    dealt = saved(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    sums = sorted((r["_part"], r["s"]) for r in dealt.groupBy("_part").agg(F.sum(value).alias("s")).collect())
    before, total = [], 0
    for part, s in sums:
        before.append((part, total))
        total += s or 0
    base = spark.createDataFrame(before, "_part int, _before long")
    w = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    own = F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.join(F.broadcast(base), "_part").withColumn(out, F.col("_before") + own).drop("_part", "_before")
