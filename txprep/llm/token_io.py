"""Token-ID / binary output: fixed-width bit packing with block offsets.

Every id takes the minimum number of bits for the vocabulary, lowest bit
first. Ids are packed in blocks of ``BLOCK``; each block starts on a byte and
its offset is kept, so any range of ids is found without reading what is before
it and unpacked with a few numpy operations.

A *shard* is one self-contained binary image::

    magic "TKB1" | width u16 | flags u16 | vocab u32 | block u32
    | n_docs u64 | n_ids u64 | n_blocks u64
    block offsets u64[n_blocks + 1]       (bytes into the payload)
    doc ids i64[n_docs] | doc starts u64[n_docs + 1] | id is null u8[n_docs]
    payload

``write_tokens`` range-partitions the documents by id, then by a hash of the text
and a number that tells repeated rows apart (one shuffle of the texts), so that
an id, or none, shared by many rows is spread over many tasks. They encode and
pack and let Spark commit the images, one row each, to the shared folder;
``image`` saved as a file is the shard as it stands. Nothing passes through the
driver.

Defined results: a null text is empty; every document ends with ``end_id``, so
an empty one has one id; a null ``doc_id`` is kept and sorts first; rows with
the same ``doc_id`` follow each other by the text's hash, each with its own ids;
a very long text has a shard of its own; an empty table gives an empty directory
of shards and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, text_or_empty
from .encoding import worker_encoder

MAGIC = b"TKB1"
BLOCK = 4096
HEADER = struct.Struct("<4sHHIIQQQ")
#: A shard is closed at this many ids; a longer document has a shard of its own.
SHARD_IDS = 1 << 21

SHARD_SCHEMA = "part int, shard int, n_docs long, n_ids long, width int, image binary"
DOC_SCHEMA = "part int, shard int, pos long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def width_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` at ``width`` bits each, lowest bit first, padded to a byte."""
    if width in (8, 16, 32):                      # whole bytes: the same layout without bit work
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed ``data``, as uint32."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    weights = np.uint32(1) << np.arange(width, dtype=np.uint32)
    return (bits.reshape(count, width) * weights).sum(axis=1, dtype=np.uint32)


def pack_shard(doc_ids: list[int | None], docs: list[np.ndarray], vocab_size: int) -> bytes:
    """One shard image of ``docs`` (an id array each)."""
    width = width_for(vocab_size)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype("<u8")
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint32)
    if len(ids) and int(ids.max()) >= vocab_size:
        raise ValueError(f"id {int(ids.max())} is outside the vocabulary of {vocab_size}")
    blocks = [pack(ids[i:i + BLOCK], width) for i in range(0, len(ids), BLOCK)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    head = HEADER.pack(MAGIC, width, 0, vocab_size, BLOCK, len(docs), len(ids), len(blocks))
    return b"".join([head, offsets.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     starts.tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(), *blocks])


class Shard:
    """Random access to a shard image."""

    def __init__(self, image: bytes):
        magic, self.width, _, self.vocab_size, self.block, n_docs, self.n_ids, n_blocks = HEADER.unpack_from(image)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER.size
        self.offsets = np.frombuffer(image, "<u8", n_blocks + 1, at)
        at += 8 * (n_blocks + 1)
        self.doc_ids = np.frombuffer(image, "<i8", n_docs, at)
        at += 8 * n_docs
        self.starts = np.frombuffer(image, "<u8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.null_id = np.frombuffer(image, np.uint8, n_docs, at).astype(bool)
        self.payload = memoryview(image)[at + n_docs:]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` (exclusive); reads only the blocks they are in."""
        if lo >= hi:
            return np.empty(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        parts = []
        for b in range(first, last + 1):
            count = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack(self.payload[int(self.offsets[b]):int(self.offsets[b + 1])], self.width, count))
        return np.concatenate(parts)[lo - first * self.block:hi - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _encode_partition(path: str, end_id: int, shard_ids: int):
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = worker_encoder(path)
        ids, docs, size, shard = [], [], 0, 0

        def flush():
            image = pack_shard(ids, docs, enc.vocab_size)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                "width": pa.array([width_for(enc.vocab_size)], pa.int32()), "image": pa.array([image], pa.binary())})

        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            for doc_id, encoded in zip(batch.column("doc_id").to_pylist(), enc.encode_slices(texts)):
                doc = np.append(encoded, end)
                if docs and size + len(doc) > shard_ids:
                    yield flush()
                    ids, docs, size, shard = [], [], 0, shard + 1
                ids.append(doc_id)
                docs.append(doc)
                size += len(doc)
        if docs:
            yield flush()
    return run


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, image in zip(batch.column("part").to_pylist(), batch.column("shard").to_pylist(),
                                      batch.column("image")):
            s = Shard(image.as_py())
            n = len(s.doc_ids)
            crc = [zlib.crc32(s.document(i).astype("<u4").tobytes()) for i in range(n)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32()),
                "pos": pa.array(np.arange(n), pa.int64()), "doc_id": pa.array(s.doc_ids, mask=s.null_id),
                "local_start": pa.array(s.starts[:-1].astype(np.int64)),
                "n_tokens": pa.array(np.diff(s.starts.astype(np.int64))), "ids_crc32": pa.array(crc, pa.int64())})


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write the shards to ``path`` in ascending id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = ["doc_id", "hash", "copy"]
    keyed = rows.withColumns({"hash": F.xxhash64("text"), "copy": F.monotonically_increasing_id() % 1024})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(_encode_partition(tokenizer, end_id, shard_ids), SHARD_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the shards at ``path``: ``doc_id, start,
    n_tokens, ids_crc32, part, shard, pos`` (``start``: ids of all documents
    before it; the last three tell where ``Shard.document`` finds it)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    starts = prefix_sums(shards.select("part", "shard", "n_ids"), "part", ["shard"], "n_ids", "shard_start")
    docs = shards.select("part", "shard", "image").mapInArrow(_read_shards, DOC_SCHEMA)
    return docs.join(starts.select("part", "shard", "shard_start"), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
        "part", "shard", "pos")
