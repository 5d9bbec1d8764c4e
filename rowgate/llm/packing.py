"""Sequences of at most a fixed number of tokens, packed from whole documents by best fit.

Only lengths matter to the packing, and there are no more of them than a sequence has tokens. The
tasks encode and cut the documents and count pieces by length; the driver packs that histogram, of
bounded size for any corpus, into groups of equal sequences; the tasks then look up the place of
the n-th piece of a length. Null texts are empty; a document of no tokens is its end token alone;
rows that repeat a ``doc_id`` are packed as documents of their own; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.common import id_and_text, stored
from rowgate.llm.tokens import word_ids

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack ``counts[length]`` pieces of each length. Returns ``(lengths in a sequence, sequences)``.

    Of pieces above a third of the capacity a sequence holds two at most. They are matched greedily,
    longest first, each with the longest other one that still fits. The shorter pieces, longest
    first, go to the sequence with the least room that takes them. Equal pieces are placed together,
    so the work depends on the number of lengths only.
    """
    left = {length: n for length, n in counts.items() if n and length * 3 > capacity}
    room: dict[int, list[list]] = defaultdict(list)  # free tokens -> [lengths, sequences]
    for length in sorted(left, reverse=True):
        while left[length]:
            mate = max((m for m in left if m <= capacity - length and left[m] > (m == length)), default=0)
            if not mate:
                room[capacity - length].append([(length,), left[length]])
                left[length] = 0
                continue
            n = left[length] // 2 if mate == length else min(left[length], left[mate])
            room[capacity - length - mate].append([(length, mate), n])
            left[length] -= n
            left[mate] -= n
    for length in sorted((x for x, n in counts.items() if n and x * 3 <= capacity), reverse=True):
        n = counts[length]
        while n:
            free = min((f for f, groups in room.items() if f >= length and groups), default=0)
            if not free:
                room[capacity].append([(), -(-n // (capacity // length))])
                continue
            held, bins = room[free].pop()
            each = free // length
            full = min(bins, n // each)
            if full:
                room[free - each * length].append([held + (length,) * each, full])
            elif bins:
                room[free - n * length].append([held + (length,) * n, 1])
                full, each = 1, n
            if bins > full:
                room[free].append([held, bins - full])
            n -= full * each
    return [(held, n) for groups in room.values() for held, n in groups if held]


def places(groups: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: from which n-th piece on, the first sequence of that run, and the offset there."""
    rows, used, sequence = defaultdict(list), defaultdict(int), 0
    for held, n in groups:
        offset = 0
        for length in held:
            rows[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(column, np.int64) for column in zip(*found)) for length, found in rows.items()}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: all full but the first."""
    first = n % capacity or capacity
    bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of all documents; ``nth`` counts those of equal length in one ``shard``, a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, seen = word_ids(tokenizer), np.array([end_id], "<u4").tobytes(), defaultdict(int)
        shard = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                ids = ids.tobytes() + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), shard, seen[length]))
                    seen[length] += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "nth"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return id_and_text(docs).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece, with its sequence and the offset in it. Sequences have no gaps."""
    pieces = stored(cut_documents(docs, tokenizer, end_id, capacity), "pieces")  # fixes shard and nth
    counts = stored(pieces.groupBy("shard", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(places(pack_lengths(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                first, sequences, offsets = table.value[int(one)]
                run = np.searchsorted(first, nth[mine], "right") - 1
                sequence[mine] = sequences[run] + nth[mine] - first[run]
                offset[mine] = offsets[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # A row for each shard and length: it grows with the corpus, so it is not to be broadcast.
    ranked = pieces.join(bases.hint("merge"), ["shard", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("nth")
    )
    return ranked.mapInArrow(place, PLACED)
