"""SimHash near-duplicates: fingerprints of 4-word shingles, linked within a few bits.

Fingerprints are embedded as the bit counts of 2-bit segments. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so a range-join on a grid of
embeddings finds all links and an exact count of differing bits keeps no others. Of four differing
bits one 32-bit half holds two at most; two embeddings of a half at distance two have a grid point
within one step of both. Each fingerprint therefore goes, for each half, to its own point and the
points one step away, and links are sought among the fingerprints of one point.

Equal fingerprints are merged first. A point with very many different fingerprints is cut into
blocks, and pairs of blocks are tasks of their own. Inside a point only the edges of a spanning
forest are kept, so a large group gives about as many links as it has members, never all pairs.

Null texts are empty; texts without words have fingerprint zero and link like any other; rows that
repeat a ``doc_id`` keep a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import connected_components, id_and_text, stored

SHINGLE, SEED, BITS = 4, 42, 4
HOT, BLOCK = 2_000, 4_000
_CHUNK = 65_536
_PAIRS = np.uint64(0x55555555)


def fingerprint(text: str) -> int:
    """The 64 majority bits of the hashes of all shingles."""
    data = b" ".join(text.encode().lower().split())
    if not data:
        return 0
    blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = [0, *(blanks + 1).tolist()], [*blanks.tolist(), len(data)]
    if len(starts) < SHINGLE:
        starts, ends = [0], [len(data)]
    else:
        ends = ends[SHINGLE - 1 :]
    counts, total, digest = np.zeros(64, np.int64), len(ends), xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        hashes = [digest(data[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed 64-bit number ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def embedding(fps: np.ndarray, half: int) -> np.ndarray:
    """Bit counts of the sixteen 2-bit segments of a half, two bits per count."""
    part = (fps.view(np.uint64) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
    return (part & _PAIRS) + ((part >> np.uint64(1)) & _PAIRS)


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The own point of each fingerprint, for each half, and those one step away."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for half in (0, 1):
            code = embedding(fps, half)
            cells, members = [code], [fps]
            for segment in range(16):
                step, count = np.uint64(1 << 2 * segment), (code >> np.uint64(2 * segment)) & np.uint64(3)
                for near, inside in ((code + step, count < 2), (code - step, count > 0)):
                    cells.append(near[inside])
                    members.append(fps[inside])
            cell = np.concatenate(cells) | np.uint64(half << 32)
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(np.concatenate(members))], names=["cell", "fp"])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        cells = [embedding(fps, half) | np.uint64(half << 32) for half in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).view(np.int64))], names=["cell"])


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A point and those one step away, each with the point's count."""
    for batch in batches:
        cell, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
        cells, counts = [cell], [n]
        for segment in range(16):
            step, count = np.uint64(1 << 2 * segment), (cell >> np.uint64(2 * segment)) & np.uint64(3)
            for near, inside in ((cell + step, count < 2), (cell - step, count > 0)):
                cells.append(near[inside])
                counts.append(n[inside])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.concatenate(counts))], names=["cell", "n"])


def _forest(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is connected among ``fps``, one fewer than each group has members."""
    left = fps
    while len(left):
        open_, left = [left[0]], left[1:]
        while open_ and len(left):
            at = open_.pop()
            near = np.bitwise_count(left ^ at) <= bits
            if near.any():
                found, left = left[near], left[~near]
                yield np.full(len(found), at), found
                open_.extend(found)


def _linked(key: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for start, size in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
        for a, b in _forest(fps[start : start + size], bits):
            left.append(a)
            right.append(b)
    small = np.repeat((sizes <= 16) & (sizes > 1), sizes)
    key, fps = key[small], fps[small]
    for apart in range(1, 16):
        a, b = fps[:-apart], fps[apart:]
        same = key[:-apart] == key[apart:]
        if not same.any():
            break
        a, b = a[same], b[same]
        near = np.bitwise_count(a ^ b) <= bits
        left.append(a[near])
        right.append(b[near])
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fp`` (distinct) within ``bits`` bits, at
    most four. A group of more than a few gives a spanning forest."""
    if not 0 <= bits <= 4:
        raise ValueError("links are found up to four differing bits")
    counts = distinct.mapInArrow(_own, "cell long").groupBy("cell").agg(F.count("*").alias("n"))
    # A point that no crowded one touches has at most 33 x HOT fingerprints.
    crowded = counts.where(F.col("n") > HOT).mapInArrow(_around, "cell long, n long")
    crowded = stored(crowded.groupBy("cell").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks")), "crowded")
    dealt = distinct.mapInArrow(_points, "cell long, fp long")
    if crowded.isEmpty():  # every point is one block
        dealt = dealt.withColumnRenamed("cell", "key")
    else:
        blocks = F.coalesce("blocks", F.lit(1))
        mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
        dealt = dealt.join(crowded, "cell", "left").select("cell", "fp", mine.alias("mine"), other)
        dealt = dealt.select(F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "fp")
    dealt = dealt.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, members = [], []
        for batch in batches:
            key, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last:
                keys.append(key[:last])
                members.append(fps[:last])
            if last or (keys and keys[0][0] != key[-1]):
                yield emit(np.concatenate(keys), np.concatenate(members))
                keys, members = [], []
            keys.append(key[last:])
            members.append(fps[last:])
        if keys:
            yield emit(np.concatenate(keys), np.concatenate(members))

    def emit(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = _linked(key, fps, bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest ``doc_id``
    reachable over links of at most ``bits`` differing bits."""
    fps = stored(fingerprints(docs), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = connected_components(links(distinct.select("fp"), bits))
    named = distinct.join(labels, distinct.fp == labels.id, "left").select("fp", "first", F.coalesce("component", "fp").alias("label"))
    named = stored(named, "classes")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "label").select("fp", "component_id")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(classes, "fp").select("doc_id", shown, "component_id")


def one_per_group(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``docs``, all columns, without near copies: of each group the smallest ``doc_id`` stays, and
    one row of those that repeat it. Rows without a ``doc_id`` stay."""
    groups = near_duplicates(docs.where(F.col("doc_id").isNotNull()), bits)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").select(*[docs[c] for c in docs.columns]).dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
