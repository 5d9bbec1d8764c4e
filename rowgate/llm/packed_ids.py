"""Token ids in fixed-width bit-packed shard files.

A shard holds the ids of a range of documents, in ascending ``doc_id`` order. Each id takes the
fewest bits that hold the vocabulary. Layout, all numbers little-endian:

    header     magic ``IDSPACK1``, u32 bits, u32 ids per block
    blocks     ids per block x bits, least significant bit first, padded to whole bytes
    offsets    u64 per block: where it begins, and where the last one ends
    documents  i64 doc_id, u8 "doc_id is null", u64 first id of each document in the shard
    trailer    u64 ids, u64 documents, u64 place of the offsets

Shards are written straight to the shared folder under names no other attempt has. The manifest, a
Parquet table that Spark commits, names those that count: what a lost or repeated task leaves
behind is never read. Null texts are empty; rows that repeat a ``doc_id`` stay separate documents,
in the order of their texts; rows without a ``doc_id`` come first; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import id_and_text
from rowgate.llm.tokens import word_ids
from rowgate.session import new_folder

MAGIC, BLOCK = b"IDSPACK1", 65_536
MANIFEST = "path string, shard int, n_ids long, n_docs long"


def width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    return values << np.uint32(by) if by >= 0 else values >> np.uint32(-by)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after the other, ``bits`` bits each. Eight ids fill ``bits`` bytes, so each byte
    of all such groups is put together at once from the ids that reach into it."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint32)
    groups.ravel()[: len(ids)] = ids
    found = np.zeros((len(groups), bits), np.uint8)
    for byte in range(bits):
        for i in range(8 * byte // bits, min(8, -(-8 * (byte + 1) // bits))):
            found[:, byte] |= _shifted(groups[:, i], i * bits - 8 * byte).astype(np.uint8)
    return found.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of a block."""
    padded = np.zeros(-(-count // 8) * bits, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    bytes_ = padded.reshape(-1, bits).astype(np.uint32)
    found = np.zeros((len(bytes_), 8), np.uint32)
    for i in range(8):
        for byte in range(i * bits // 8, -(-(i + 1) * bits // 8)):
            found[:, i] |= _shifted(bytes_[:, byte], 8 * byte - i * bits)
    return (found.ravel() & np.uint32((1 << bits) - 1))[:count]


class ShardWriter:
    """Appends documents to one shard; holds one block and the index of the documents."""

    def __init__(self, out, vocabulary: int, block: int = BLOCK):
        self._out, self._bits, self._block = out, width(vocabulary), block
        self._waiting, self._n_waiting = [], 0
        self._docs, self._starts, self._offsets, self.n_ids = [], [], [16], 0
        out.write(MAGIC + struct.pack("<II", self._bits, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append(doc_id)
        self._starts.append(self.n_ids)
        self.n_ids += len(ids)
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        if self._n_waiting >= self._block:
            self._flush(self._block)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self._waiting) if self._waiting else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= max(1, least):
            data = pack(ids[at : at + self._block], self._bits)
            self._out.write(data)
            self._offsets.append(self._offsets[-1] + len(data))
            at += self._block
        self._waiting, self._n_waiting = [ids[at:]], max(0, len(ids) - at)

    def close(self) -> None:
        self._flush(0)
        docs = np.array([d or 0 for d in self._docs], "<i8")
        nulls = np.array([d is None for d in self._docs], np.uint8)
        for part in (np.array(self._offsets, "<u8"), docs, nulls, np.array(self._starts, "<u8")):
            self._out.write(part.tobytes())
        self._out.write(struct.pack("<QQQ", self.n_ids, len(docs), self._offsets[-1]))


class ShardReader:
    """Random access to one shard: only the blocks that hold the wanted ids are read."""

    def __init__(self, source):
        self._in = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a shard of packed ids")
        self._bits, self._block = struct.unpack("<II", self._read(8, 8))
        end = source.size()
        self.n_ids, n_docs, at = struct.unpack("<QQQ", self._read(end - 24, 24))
        n_blocks = -(-self.n_ids // self._block)
        tail = self._read(at, end - 24 - at)
        self._offsets = np.frombuffer(tail, "<u8", n_blocks + 1)
        at = 8 * (n_blocks + 1)
        self.docs = np.frombuffer(tail, "<i8", n_docs, at)
        self.nulls = np.frombuffer(tail, np.uint8, n_docs, at + 8 * n_docs)
        self.starts = np.append(np.frombuffer(tail, "<u8", n_docs, at + 9 * n_docs), self.n_ids).astype(np.int64)
        self._last = (-1, None)

    def _read(self, at: int, n: int) -> bytes:
        self._in.seek(at)
        return self._in.read(n)

    def _ids(self, block: int) -> np.ndarray:
        if self._last[0] != block:
            a, b = int(self._offsets[block]), int(self._offsets[block + 1])
            count = min(self._block, self.n_ids - block * self._block)
            self._last = (block, unpack(self._read(a, b - a), count, self._bits))
        return self._last[1]

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids at places ``start`` to ``end`` of the shard."""
        found = []
        while start < end:
            block, at = divmod(start, self._block)
            found.append(self._ids(block)[at : at + end - start])
            start += len(found[-1])
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def document(self, i: int) -> np.ndarray:
        return self.slice(int(self.starts[i]), int(self.starts[i + 1]))


def _file(path: str):
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, folder: str, block: int = BLOCK) -> DataFrame:
    """Encode every text, append ``end_id`` and write the shards below ``folder``. Returns the
    manifest, read from ``folder/manifest``. Ranges of ``doc_id`` are dealt out by rows, so a hot
    source spreads; a task holds one batch of texts and one block of ids."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encoder = None, word_ids(tokenizer)
        end = np.array([end_id], "<u4")
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            if writer is None:
                system, inside = _file(path)
                system.create_dir(inside.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(inside)
                writer = ShardWriter(out, vocabulary, block)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                writer.add(doc_id, np.append(ids, end))
        if writer is not None:
            writer.close()
            out.close()
            values = [[path], [shard], [writer.n_ids], [len(writer._docs)]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.string(), pa.int32(), pa.int64(), pa.int64()))], names=["path", "shard", "n_ids", "n_docs"])

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read_back(manifest: DataFrame, name: str, kind: str, make: Callable[[bytes], object]) -> DataFrame:
    arrow = {"binary": pa.binary(), "long": pa.int64()}[kind]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, inside = _file(path)
                with system.open_input_file(inside) as source:
                    shard = ShardReader(source)
                    for at in range(0, len(shard.docs), 500):
                        some = range(at, min(at + 500, len(shard.docs)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([None if shard.nulls[i] else int(shard.docs[i]) for i in some], pa.int64()),
                                pa.array(shard.starts[some.start : some.stop] + base, pa.int64()),
                                pa.array(np.diff(shard.starts[some.start : some.stop + 1]), pa.int64()),
                                pa.array([make(shard.document(i).astype("<u4").tobytes()) for i in some], arrow),
                            ],
                            names=["doc_id", "start", "n_tokens", name],
                        )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = max(1, manifest.count())
    return placed.repartition(files).mapInArrow(read, f"doc_id long, start long, n_tokens long, {name} {kind}")


def read_ids(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (unsigned
    32-bit, little-endian) of every document, read back from the shards of a manifest."""
    return _read_back(manifest, "ids", "binary", bytes)


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write all documents to a new folder of shards and read them back, with the crc32 of the ids
    of each instead of the ids."""
    manifest = write_ids(docs, tokenizer, end_id, vocabulary, new_folder(spark, "ids"))
    return _read_back(manifest, "ids_crc32", "long", zlib.crc32)
