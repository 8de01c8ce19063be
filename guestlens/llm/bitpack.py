"""Token ids in binary shards of fixed-width bits.

Each id takes the fewest bits that hold the vocabulary. Ids are cut into blocks
of `BLOCK`; the offsets of the blocks let a reader fetch any stretch without the
rest, and numpy unpacks a block at a time. A shard is one file:

    magic, 8 bytes; bits and ids per block, u32; documents, ids and blocks, u64
    doc_id, i64 per document; known, u8 (0: the doc_id is null); end, u64 (ids of
    the shard up to the document's end); offsets, u64 per block and one more
    the blocks; within one, id k has bits k * bits and up, lowest bit first

Shards are ranges of doc_id in ascending order, so a document's place in the
whole is the shard's first place plus its own. A task writes to a name of its
own attempt and then renames; a task that runs again writes the same bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import ship, stored, text_bytes
from guestlens.llm.tokens import encoder

MAGIC = b"GLBITS01"
HEADER = struct.Struct("<8sIIQQQ")
BLOCK = 4096
#: Bytes of text per shard.
SHARD_BYTES = 16_000_000


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids to bits, lowest first, padded to whole bytes."""
    flat = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(flat, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    """The n ids that pack() made these bytes of."""
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(n)


def shard_bytes(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, bits: int) -> Iterator[bytes]:
    """The file of a shard, piece by piece."""
    blocks = -(-len(ids) // BLOCK)
    yield HEADER.pack(MAGIC, bits, BLOCK, len(doc_ids), len(ids), blocks)
    yield np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    yield np.array([d is not None for d in doc_ids], dtype="u1").tobytes()
    yield np.asarray(ends, dtype="<u8").tobytes()
    sizes = np.full(blocks, BLOCK * bits // 8, dtype="<u8")
    if blocks:
        sizes[-1] = -(-(len(ids) - (blocks - 1) * BLOCK) * bits // 8)
    yield np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes()
    for i in range(0, blocks, 64):
        yield pack(ids[i * BLOCK : (i + 64) * BLOCK], bits)


class Shard:
    """Random access to a shard."""

    def __init__(self, file):
        self.file = file
        magic, self.bits, self.block, n_docs, self.n_ids, blocks = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of packed ids")
        ids = np.frombuffer(file.read(8 * n_docs), "<i8")
        known = np.frombuffer(file.read(n_docs), "u1")
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.ends = np.frombuffer(file.read(8 * n_docs), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.payload = file.tell()

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end of the shard, reading only the blocks they lie in."""
        if start >= end:
            return np.empty(0, "<u4")
        first, last = start // self.block, -(-end // self.block)
        self.file.seek(self.payload + int(self.offsets[first]))
        raw = self.file.read(int(self.offsets[last] - self.offsets[first]))
        n = min(self.n_ids, last * self.block) - first * self.block
        return unpack(raw, self.bits, n)[start - first * self.block : end - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def _file_system(uri: str):
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its store named, as tasks on other machines need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file:///" + whole.removeprefix("file:").lstrip("/") if whole.startswith("file:") else whole


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write doc_id, text as shards; returns shard, path, n_docs, n_ids, start.

    Defined cases: a null or empty text has the end id alone; null doc_ids come
    first and stay null; rows with equal doc_ids are ordered by a hash of their
    text; no rows make no shards, or shards of no documents.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = qualified(spark, folder)
    shards = max(spark.sparkContext.defaultParallelism, -(-text_bytes(docs) // SHARD_BYTES))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        encode = encoder(tokenizer)
        end = np.uint32(end_id).astype("<u4").tobytes()
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        for batch in batches:
            doc_ids += batch.column("doc_id").to_pylist()
            parts += [x + end for x in encode.encode(batch.column("text").cast(pa.binary()).to_pylist())]
        if not doc_ids:
            return
        ends = np.cumsum([len(p) // 4 for p in parts])
        ids = np.frombuffer(b"".join(parts), "<u4")
        del parts
        bits = max(1, int(max(encode.size - 1, end_id)).bit_length())
        shard = task.partitionId()
        name = f"{folder}/shard-{shard:08d}.bits"
        store, path = _file_system(name)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.{task.taskAttemptId()}"
        with store.open_output_stream(own) as out:
            for piece in shard_bytes(doc_ids, ends, ids, bits):
                out.write(piece)
        try:
            store.move(own, path)
        except OSError:  # another attempt has put the same bytes there
            if not store.get_file_info(path).is_file:
                raise
            store.delete_file(own)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "path": name, "n_docs": len(doc_ids), "n_ids": len(ids)}])

    written = stored(rows.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "bitpack-shards")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return written.withColumn("start", F.coalesce(before, F.lit(0)))


def read_shards(shards: DataFrame) -> DataFrame:
    """What write_shards() returned -> doc_id, start, n_tokens, ids, from the files.

    ids are little-endian unsigned 32-bit integers as bytes. Each shard is read
    by one task, a stretch of blocks at a time.
    """
    spark = shards.sparkSession
    ship(spark)
    n = max(1, shards.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _file_system(row["path"])
                with store.open_input_file(path) as file:
                    yield from _documents(Shard(file), row["start"])

    spread = shards.select("path", "start").repartition(n)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(shard: Shard, base: int, at_once: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    k, n = 0, len(shard.doc_ids)
    while k < n:
        first = int(shard.ends[k - 1]) if k else 0
        last = max(k + 1, int(np.searchsorted(shard.ends, first + at_once, "right")))
        raw = shard.ids(first, int(shard.ends[last - 1])).tobytes()
        ends = shard.ends[k:last]
        starts = np.concatenate([[first], ends[:-1]])
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(shard.doc_ids[k:last], pa.int64()),
                "start": pa.array(starts + base, pa.int64()),
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "ids": pa.array([raw[4 * (s - first) : 4 * (e - first)] for s, e in zip(starts, ends)], pa.binary()),
            }
        )
        k = last
