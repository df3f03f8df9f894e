"""Reading exports, layers and cards; write policies, partition refresh and manifests."""

from __future__ import annotations

import ctypes
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import _hashlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Longest file whose digest one task makes, and the extensions of files that Hadoop unpacks while it reads them.
DIGEST_BYTES, PACKED = 128 << 20, r"\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"


def union_exports(spark: SparkSession, paths: list[str], columns: dict[str, str], key: str, slug_pattern: str) -> DataFrame:
    """Named columns (name -> type) of many wide CSV exports, tagged with the slug found in each file's path.

    Files may lack columns or order them differently. Raises on a repeated key, with examples.
    """
    def one(path: str) -> DataFrame:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        got = [(F.col(f"`{c}`") if c in raw.columns else F.lit(None)).try_cast(kind).alias(c) for c, kind in columns.items()]
        return raw.select(*got, F.regexp_extract(F.col("_metadata.file_path"), slug_pattern, 1).alias("source_slug"))

    out = reduce(DataFrame.unionByName, map(one, paths))
    repeated = out.groupBy(key).count().where("count > 1").select(key).limit(5).collect()
    if repeated:
        raise ValueError(f"repeated {key}: {sorted(str(r[0]) for r in repeated)}")
    return out


def union_partitions(frames: dict, part: str, key: str, lat: str, lon: str, date: str) -> DataFrame:
    """One frame per part (year): typed coordinates and date, a dd/MM/yyyy text, and a row id in order of (part, key).

    The row id is a running count over ranges of (part, key): no part is gathered in one task.
    """
    from pluvia.operators.ranks import numbered

    typed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(part, F.lit(p)) for p, df in frames.items()])
    typed = typed.withColumn(lat, F.col(lat).try_cast("double")).withColumn(lon, F.col(lon).try_cast("double")).withColumn(date, F.col(date).try_cast("date"))
    typed = typed.withColumn("date_text", F.date_format(date, "dd/MM/yyyy"))
    return numbered(typed, [part, key], "row_id").withColumn("row_id", F.col("row_id") + 1)


def explode_parallel(df: DataFrame, struct: str, fields: list[str]) -> DataFrame:
    """One row per position of a struct of parallel arrays."""
    rest = [c for c in df.columns if c != struct]
    zipped = F.arrays_zip(*[F.col(f"{struct}.{f}").alias(f) for f in fields])
    return df.select(*rest, F.inline(zipped))


def union_sheets(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_layers(frames: dict[str, DataFrame], tag: str = "origin") -> DataFrame:
    """Same-layer tables of several origins, tagged; refuses frames whose `crs` (metadata of the geometry column) differ."""
    crs = {name: {f.metadata.get("crs") for f in df.schema.fields if "crs" in f.metadata} for name, df in frames.items()}
    if len({frozenset(c) for c in crs.values()}) > 1:
        raise ValueError(f"layers differ in crs: { {k: sorted(map(str, v)) for k, v in crs.items()} }")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(n)) for n, df in frames.items()])


def select_layer(df: DataFrame, layer: str, columns: list[str], where: Column | None = None) -> DataFrame:
    out = df.where(F.col("layer") == layer)
    return (out if where is None else out.where(where)).select(*columns)


def read_typed(spark: SparkSession, path: str, schema: StructType | str, dates: list[str] = (), text_keys: list[str] = (), empty_text: list[str] = ()) -> DataFrame:
    """CSV with a declared schema: dates parsed, text keys kept with leading zeros, empty text restored."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    raw = StructType([StructField(f.name, StructType.fromDDL("x string")["x"].dataType if f.name in text_keys or f.name in dates else f.dataType) for f in declared])
    df = spark.read.schema(raw).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.withColumns({c: F.col(c).try_cast("date") for c in dates}) if dates else df
    return df.fillna("", subset=list(empty_text)) if empty_text else df


def write_policy(df: DataFrame, path: str, on_exists: str) -> None:
    """skip, overwrite or error where the output is there already."""
    df.write.mode({"skip": "ignore", "overwrite": "overwrite", "error": "error"}[on_exists]).parquet(path)


def refresh_partitions(df: DataFrame, path: str, part: str, current: list) -> None:
    """Writes only the current parts; closed ones stay as they are."""
    fresh = df.where(F.col(part).isin(current))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path (any that Spark reads) and a function from text to its paths."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark._jsc.hadoopConfiguration()), new


def recover(spark: SparkSession, path: str) -> None:
    """Puts the previous table back if a swap broke off after it was set aside."""
    files, at = _files(spark, path)
    if not files.exists(at(path)) and files.exists(at(path + ".previous")):
        files.rename(at(path + ".previous"), at(path))


def write_validated(df: DataFrame, check: Callable[[DataFrame], DataFrame], path: str) -> None:
    """Writes only if the check's report has no row; the report's first rows are the error.

    Rows are staged beside the target and checked there, so what was checked is what is kept, also where the source moves meanwhile. The
    target is then swapped by renames: the old table is set aside as <path>.previous, the staged one takes its place, the old one goes. The old
    table is whole until then; where a swap broke off, the next write (or `recover`) puts it back first. Stores without
    atomic renames copy instead, and readers may then find no table for a moment.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    files, at = _files(spark, path)
    staged, previous = at(f"{path}.staged-{uuid.uuid4().hex}"), at(path + ".previous")
    try:
        df.write.parquet(staged.toString())
        broken = check(spark.read.schema(df.schema).parquet(staged.toString())).limit(20).collect()
        if broken:
            raise ValueError("; ".join(str(r.asDict()) for r in broken))
        if files.exists(at(path)):
            files.delete(previous, True)  # left over from a swap that ended but for this
            if not files.rename(at(path), previous):
                raise OSError(f"{path} can't be set aside")
        if not files.rename(staged, at(path)):
            recover(spark, path)
            raise OSError(f"{path} can't be replaced")
    finally:
        files.delete(staged, True)
    files.delete(previous, True)


class Sha256:
    """A SHA-256 whose state can be handed on as bytes. It is OpenSSL's, which Python links; hashlib keeps its state to itself."""

    def __init__(self, state: bytes = b""):
        self.lib, self.held = ctypes.CDLL(_hashlib.__file__), ctypes.create_string_buffer(state, 256)
        if not state:
            self.lib.SHA256_Init(self.held)

    def update(self, data: bytes) -> None:
        self.lib.SHA256_Update(self.held, data, ctypes.c_size_t(len(data)))

    def state(self) -> bytes:
        return self.held.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self.lib.SHA256_Final(out, self.held)
        return out.raw.hex()

    @staticmethod
    def usable() -> bool:
        """Whether this Python's OpenSSL offers it."""
        try:
            first = Sha256()
            first.update(b"a" * 100)
            second = Sha256(first.state())
            second.update(b"b" * 100)
            return second.hexdigest() == hashlib.sha256(b"a" * 100 + b"b" * 100).hexdigest()
        except (AttributeError, OSError):
            return False


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified, digest) of the files under a path. Files of up to DIGEST_BYTES are read whole, in parallel; longer ones by
    digest_by_ranges, except those that Hadoop would unpack by their extension, and where Python's OpenSSL doesn't hand its state on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).withColumnRenamed("modificationTime", "modified")
    whole = lambda df: df.select("path", "length", "modified", F.sha2("content", 256).alias("digest"))
    if not Sha256.usable():
        return whole(files)
    # conditions on the length alone reach the source, which then doesn't read the others
    short, long, packed = files.where(F.col("length") <= DIGEST_BYTES), files.where(F.col("length") > DIGEST_BYTES), F.col("path").rlike(PACKED)
    found = long.where(~packed).select("path", "length", "modified").collect()
    if not found:
        return whole(files)
    with ThreadPoolExecutor(8) as threads:
        digests = threads.map(lambda f: digest_by_ranges(spark, f["path"], f["length"]), found)
        known = spark.createDataFrame([(*f, d) for f, d in zip(found, digests, strict=True)], whole(files).schema)
    unpacked = [f["path"] for f in long.where(packed).select("path").collect()]
    others = whole(files.where(F.col("length") > DIGEST_BYTES).where(F.col("path").isin(unpacked))) if unpacked else None
    return reduce(DataFrame.unionByName, [df for df in (whole(short), known, others) if df is not None])


def digest_by_ranges(spark: SparkSession, path: str, length: int) -> str:
    """SHA-256 of a file that no task reads whole: its ranges (spark.sql.files.maxPartitionBytes) are read one after the other, each by a task
    that goes on with the state of the last. Spark's text source cuts them at line feeds, so a range ends with the line that
    begins in it. The source drops a byte order mark and doesn't tell whether the file ends in a line feed; the length does."""
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
    lines = spark.read.option("lineSep", "\n").text(literal).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("start"))

    def going_on(state: bytes, done: int, at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digest, n, last = Sha256(state), done, at
            for whole in batches:
                for i in range(0, whole.num_rows, 4096):
                    values, starts = (c.to_pylist() for c in whole.slice(i, 4096).columns)
                    if starts != sorted(starts) or starts[0] < last:
                        raise ValueError(f"ranges of {path} out of order")
                    # each line feed goes before the line that follows it
                    text = b"\n".join(values if last < 0 else [b"", *values])
                    digest.update(text)
                    n, last = n + len(text), starts[-1]
            yield pa.RecordBatch.from_pydict({"state": [digest.state()], "done": [n], "at": [last]})

        return run

    for head in (b"", b"\xef\xbb\xbf"):
        digest = Sha256()
        digest.update(head)
        state, done, at = digest.state(), len(head), -1
        for i in range(lines.rdd.getNumPartitions()):
            after = lines.mapInArrow(going_on(state, done, at), "state binary, done long, at long").rdd
            ((state, done, at),) = spark.sparkContext.runJob(after, list, [i])
            state = bytes(state)
        if done in (length, length - 1):
            digest = Sha256(state)
            digest.update(b"\n" * (length - done))
            return digest.hexdigest()
    raise ValueError(f"{path} has {length} bytes, {done} were read")


def manifest_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """path and kind (missing, changed, unexpected) of every difference between two sets of (path, digest)."""
    a, b = expected.select("path", F.col("digest").alias("a")), actual.select("path", F.col("digest").alias("b"))
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, "path", "full").withColumn("kind", kind).where("kind is not null").select("path", "kind")


def plan_downloads(df: DataFrame, url: str, key: str, existing: DataFrame, file_col: str = "file") -> DataFrame:
    """Adds the target file name (key plus the extension in the URL's path) and a status: missing_id, empty_url, existing, pending."""
    ext = F.regexp_extract(F.parse_url(F.col(url), F.lit("PATH")), r"(\.[A-Za-z0-9]{1,5})$", 1)
    name = F.concat(F.regexp_replace(F.lower(F.col(key).cast("string")), r"[^a-z0-9]+", "_"), F.when(ext == "", ".jpg").otherwise(F.lower(ext)))
    have = existing.select(F.col(file_col).alias("_f")).distinct()
    blank = F.coalesce(F.trim(url) == "", F.lit(True))
    out = df.withColumn(file_col, F.when(~blank, name)).join(have, F.col(file_col) == F.col("_f"), "left")
    status = F.when(F.col(key).isNull(), "missing_id").when(blank, "empty_url").when(F.col("_f").isNotNull(), "existing").otherwise("pending")
    return out.withColumn("status", status).drop("_f")


def status_counts(df: DataFrame, col: str, statuses: list[str]) -> DataFrame:
    """Rows per status, all named statuses present."""
    dim = df.sparkSession.createDataFrame([(s,) for s in statuses], f"{col} string")
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return F.broadcast(dim).join(counts, col, "left").select(col, F.coalesce("n", F.lit(0)).alias("n"))


def attach_external_text(df: DataFrame, results: list[DataFrame], key: str, renames: dict[str, str]) -> DataFrame:
    """Left join of the union of result tables, one row per key (a repeated key is an error)."""
    from pluvia.operators.resolve import join_validated

    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results).withColumnsRenamed(renames)
    return join_validated(df, union, key, "1:1")


def card_fields(df: DataFrame, html: str) -> DataFrame:
    """One row per card text of an HTML column: material after its label, street and neighbourhood as parts of the address line."""
    cards = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r'(?s)<p class="card-text">(.*?)</p>'), F.lit(1))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.col("_card"), "(?i)<br */?>", "\n"), "<[^>]+>", ""))
    out = df.select(*[c for c in df.columns if c != html], F.explode(cards).alias("_card")).withColumn("_card", text)
    parts = F.split(F.regexp_extract("_card", r"^([^\n]*)", 1), ",")
    material = F.nullif(F.trim(F.regexp_extract("_card", r"Material:\s*([^\n]*)", 1)), F.lit(""))
    part = lambda i: F.nullif(F.trim(F.try_element_at(parts, F.lit(i))), F.lit(""))
    return out.withColumn("material", material).withColumn("street", part(1)).withColumn("neighborhood", part(2)).drop("_card")
