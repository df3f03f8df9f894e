"""Token ids of documents in sorted-string-table shards: prefix-compressed blocks, sparse index, Bloom filter, footer."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import ids_for_python, ids_from_python, lean, new_path, saved
from pluvia.llm.tokens import encode, forget

MAGIC = b"SSTABLE1"
BLOCK_BYTES = 1 << 18
SHARD_BYTES = 256 << 20
BLOOM_BITS, BLOOM_HASHES = 10, 7


def key_bytes(doc_id: int | None) -> bytes:
    """Keys that sort as bytes the way the ids sort as numbers; null comes first."""
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def key_id(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _bloom_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h & (2**64 - 1), h >> 64 | 1


def _bloom_bits(key: bytes, bits: int) -> list[int]:
    a, b = _bloom_hash(key)
    return [(a + i * b) % 2**64 % bits for i in range(BLOOM_HASHES)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return n, at


class ShardWriter:
    """Appends entries in key order to an open binary stream. In memory are one block, 16 bytes a key for the Bloom filter, and the
    sparse index; shards are dealt by bytes, so that stays small."""

    def __init__(self, out):
        self.out, self.at, self.index, self.hashes = out, 0, [], array("Q")
        self.block, self.last, self.first_key, self.last_key = bytearray(), b"", None, None
        self.zip, self.docs, self.ids = zstandard.ZstdCompressor(level=1), 0, 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if self.last_key is not None and key < self.last_key:
            raise ValueError("keys are out of order")
        if len(self.block) >= BLOCK_BYTES:
            self._flush()
        same = 0
        while same < min(len(key), len(self.last)) and key[same] == self.last[same]:
            same += 1
        wide = not len(ids) or int(ids.max()) > 0xFFFF
        value = ids.astype("<u4" if wide else "<u2").tobytes()
        self.block += _varint(same) + _varint(len(key) - same) + key[same:] + _varint(2 * len(ids) + wide) + value
        self.last = self.last_key = key
        self.first_key = key if self.first_key is None else self.first_key
        self.hashes.extend(_bloom_hash(key))
        self.docs, self.ids = self.docs + 1, self.ids + len(ids)

    def _flush(self) -> None:
        if self.block:
            packed = self.zip.compress(bytes(self.block))
            self.index.append([self.last.hex(), self.at, len(packed)])
            self._put(packed)
            self.block, self.last = bytearray(), b""

    def close(self) -> dict:
        self._flush()
        h = np.frombuffer(self.hashes, dtype="uint64").reshape(-1, 2)
        bits = max(64, BLOOM_BITS * len(h)) + 7 & ~7
        bloom = np.zeros(bits // 8, dtype="uint8")
        for i in range(BLOOM_HASHES):
            at = (h[:, 0] + np.uint64(i) * h[:, 1]) % np.uint64(bits)
            np.bitwise_or.at(bloom, at >> np.uint64(3), np.uint8(128) >> (at & np.uint64(7)).astype("uint8"))
        bloom_at, packed = self.at, bloom.tobytes()
        self._put(packed)
        footer = {"index": self.index, "bloom": [bloom_at, len(packed)], "docs": self.docs, "ids": self.ids}
        data = json.dumps(footer).encode()
        self._put(data + struct.pack("<II", len(data), zlib.crc32(data)) + MAGIC)
        return footer


class Shard:
    """Reads a shard through `read_at(offset, length)`: lookups by binary search, or all entries in order."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail = read_at(size - 16, 16)
        length, crc = struct.unpack("<II", tail[:8])
        data = read_at(size - 16 - length, length)
        if tail[8:] != MAGIC or zlib.crc32(data) != crc:
            raise ValueError("not a whole shard")
        self.footer = json.loads(data)
        self.index = [(bytes.fromhex(k), at, n) for k, at, n in self.footer["index"]]
        self.bloom = None

    def _entries(self, at: int, n: int):
        data = zstandard.ZstdDecompressor().decompress(self.read_at(at, n))
        i, key = 0, b""
        while i < len(data):
            same, i = _read_varint(data, i)
            more, i = _read_varint(data, i)
            key = key[:same] + data[i : i + more]
            count, i = _read_varint(data, i + more)
            wide, count = count & 1, count >> 1
            end = i + count * (4 if wide else 2)
            yield key, np.frombuffer(data[i:end], dtype="<u4" if wide else "<u2").astype("<u4")
            i = end

    def scan(self):
        for _, at, n in self.index:
            yield from self._entries(at, n)

    def maybe(self, key: bytes) -> bool:
        if self.bloom is None:
            self.bloom = self.read_at(*self.footer["bloom"])
        return all(self.bloom[b >> 3] >> (7 - (b & 7)) & 1 for b in _bloom_bits(key, 8 * len(self.bloom)))

    def get(self, key: bytes) -> list[np.ndarray]:
        """All entries of a key, in order; reads no block when the Bloom filter rules the key out."""
        if not self.maybe(key):
            return []
        low, high = 0, len(self.index)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.index[mid][0] < key else (low, mid)
        out = []
        for last, at, n in self.index[low:]:
            out += [ids for k, ids in self._entries(at, n) if k == key]
            if last > key:
                break
        return out


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_shard(path: str) -> Shard:
    store, name = _store(path)
    file = store.open_input_file(name)

    def read_at(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    return Shard(read_at, file.size())


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        name, writer, out, store = f"{folder}/part-{part:06d}.sst", None, None, None
        for batch in batches:
            for doc_id, none, data in zip(batch["id"].tolist(), batch["id_none"].tolist(), encode(batch["text"], tokenizer), strict=True):
                if writer is None:
                    store, base = _store(folder)
                    store.create_dir(base, recursive=True)
                    final = f"{base}/part-{part:06d}.sst"
                    unfinished = f"{base}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(unfinished)
                    writer = ShardWriter(out)
                ids = np.frombuffer(data + struct.pack("<I", end_id), dtype="<u4")
                writer.add(key_bytes(None if none else doc_id), ids)
        forget()
        if writer is not None:
            footer = writer.close()
            out.close()
            store.move(unfinished, final)  # a repeated task replaces the same file by the same rows
            yield pd.DataFrame({
                "part": [part], "path": [name], "first_key": [writer.first_key], "last_key": [writer.last_key], "docs": [footer["docs"]], "ids": [footer["ids"]],
            })

    return run


_MANIFEST = "part int, path string, first_key binary, last_key binary, docs long, ids long"


def write_token_table(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encodes whole texts (null: empty), appends `end_id` and writes one sorted shard per range of ids.

    Returns the manifest, one row per shard: part, path, first_key, last_key, docs, ids. Rows are dealt by range of
    (id, hash of the text), so that repeated ids spread too and come in a fixed order; null ids come first. `shards` is by default
    one for SHARD_BYTES of texts, the session's shuffle partitions at least. A shard is written under a passing name and then moved, so
    tasks that are lost or run twice leave whole files only. Empty input: no shards.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-table")
    size = 0 if shards else docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    order = [F.col("id").asc_nulls_first(), F.col("h").asc()]
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")
    sorted_rows = ids_for_python(sorted_rows)
    return saved(sorted_rows.mapInPandas(lean(_write(folder, tokenizer, end_id)), _MANIFEST), "manifest")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, at in zip(batch["path"], batch["before"].tolist(), strict=True):
            rows = []
            for key, ids in open_shard(path).scan():
                rows.append((key_id(key), at, len(ids), zlib.crc32(ids.tobytes())))
                at += len(ids)
                if len(rows) == 5000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)


def _frame(rows: list) -> pd.DataFrame:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    whole = {c: np.array(v, dtype="int64") for c, v in zip(("start", "n_tokens", "crc"), columns[1:], strict=True)}
    return pd.DataFrame({"id": pd.array(list(columns[0]), dtype="Int64"), **whole})  # by columns: rows with a null id would go through doubles


def read_token_table(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per stored document: id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). Shards are read block by block, in parallel."""
    spark = manifest.sparkSession
    before, total = [], 0
    for r in manifest.select("part", "path", "ids").orderBy("part").collect():  # one short row per shard
        before.append((r["path"], total))
        total += r["ids"]
    shards = spark.createDataFrame(before, "path string, before long").repartition(max(1, len(before)))
    read = shards.mapInPandas(lean(_read), "id long, start long, n_tokens long, crc long")
    return read.select(F.col("id").alias(id_col), "start", "n_tokens", F.col("crc").alias("ids_crc32"))


def _get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    path, shard = None, None
    for batch in batches:
        rows = []
        for doc_id, where in zip(batch["id"].tolist(), batch["path"], strict=True):
            if where != path:
                path, shard = where, open_shard(where)
            rows += [(doc_id, ids.astype("int64")) for ids in shard.get(key_bytes(doc_id))]
        yield pd.DataFrame(rows, columns=["id", "ids"])


def lookup_documents(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, ids) of the wanted ids that the table holds: each id is matched to the shards whose key range holds
    it (one row per shard, so the manifest is small) and found there by binary search."""
    key = F.concat(F.lit("01"), F.lpad(F.hex(F.col("id").bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    ids = wanted.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct().withColumn("key", key)
    at = manifest.select("path", F.hex("first_key").alias("lo"), F.hex("last_key").alias("hi"))
    hits = ids.join(F.broadcast(at), (F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi"))).select("id", "path")
    found = hits.repartition("path").sortWithinPartitions("path", "id").mapInPandas(_get, "id long, ids array<long>")
    return found.withColumnRenamed("id", id_col)
