"""Hard negatives of anchors, scored in full by the method of the Four Russians.

For each eight dimensions an anchor has a table of the 256 sums of subsets of its components. A
candidate is kept as bit planes: the byte of a plane and of eight dimensions says which of their
components have that bit set, so it is the place of their sum in the table. A score is the sum of
these look-ups, each plane shifted by its weight; the highest plane is the sign and is subtracted.
The tables of a block of anchors stand side by side, so one look-up serves all of them.

First every anchor meets the rows of its label, and its positives are the best of them. Then it meets
the rows of other labels, and for each positive the best rows within a window of its score stay.
Spark keeps the best of all cells each time.

Rows without a label, and those that ``whole_vectors`` leaves out, take no part. Rows that repeat a
``vec_id`` are rows of their own; those without one are no anchors and come last among ties. Anchors
meet vectors of their length only. Positives of negative score have an empty window. Fewer rows than
wanted are all returned; an anchor without positives, or an empty table, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.common import stored
from rowgate.llm.topk import best
from rowgate.llm.vectors import arrow_ids, ids, matrix, on_grid, whole_vectors

FACTOR, POSITIVES, NEGATIVES = 256, 5, 10
LOW, HIGH = 30, 90  # the window, in hundredths of a positive's score
_CHUNK = 256
_NEAR = ["anchor", "anchor_id", "positive", "positive_id", "score"]
_HARD = ["anchor", "positive", "negative_id", "negative_score"]


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """For each eight dimensions the sums of all subsets, by the subset as a byte: (groups, 256, anchors)."""
    n, dim = anchors.shape
    padded = np.zeros((n, -(-dim // 8) * 8), np.int64)
    padded[:, :dim] = anchors
    groups = padded.T.reshape(-1, 8, n)
    sums = np.zeros((len(groups), 256, n), np.int64)
    for bit in range(8):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + groups[:, bit, None]
    return sums if np.abs(padded).max(initial=0) >= 1 << 27 else sums.astype(np.int32)


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """Two's complement, lowest bit first: (planes, groups, rows) of bytes. The last plane is the sign."""
    width = max(int(rows.max(initial=0)).bit_length(), int(-rows.min(initial=0) - 1).bit_length() if rows.min(initial=0) < 0 else 0) + 1
    return np.stack([np.packbits((rows >> bit & 1).astype(np.uint8), axis=1, bitorder="little").T for bit in range(width)])


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, (rows, anchors)."""
    total = np.zeros((planes.shape[2], sums.shape[2]), np.int64)
    for start in range(0, len(total), _CHUNK):
        part, out = planes[:, :, start : start + _CHUNK], total[start : start + _CHUNK]
        for bit, plane in enumerate(part):
            sign = -1 if bit == len(planes) - 1 else 1
            held = np.zeros(out.shape, np.int64)
            for group, byte in zip(sums, plane):
                held += group[byte]
            out += sign * (held << bit)
    return total


def relabelled(vec_id: Column, label: Column) -> Column:
    """The label, moved on by one (of ten) where the id is divisible by seven."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def _labels(table: pa.Table) -> np.ndarray:
    return table.column("label").to_numpy()


def _positives(block: pa.Table, group: pa.Table) -> pa.Table:
    """The best rows of each anchor's label in a cell."""
    dim = group.column("dim")[0].as_py()
    anchors, held, keys = matrix(block, dim), matrix(group, dim), ids(group)
    numbers, rows, anchor_ids = block.column("row").to_numpy(), group.column("row").to_numpy(), ids(block)
    out = []
    for label in np.unique(_labels(block)):
        mine, theirs = np.flatnonzero(_labels(block) == label), np.flatnonzero(_labels(group) == label)
        if not len(theirs):
            continue
        found = scores(subset_sums(anchors[mine]), bit_planes(held[theirs]))
        for column, anchor in enumerate(mine):
            others = np.flatnonzero(rows[theirs] != numbers[anchor])
            score = found[others, column]
            chosen = best(score, keys[theirs[others]], POSITIVES)
            places = theirs[others[chosen]]
            n = len(places)
            out.append((np.full(n, numbers[anchor]), np.full(n, anchor_ids[anchor]), rows[places], keys[places], score[chosen]))
    columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64)] * 5
    arrays = [*map(pa.array, columns[:3]), arrow_ids(columns[3]), pa.array(columns[4])]
    return pa.table(arrays, names=_NEAR)


def _negatives(block: pa.Table, group: pa.Table) -> pa.Table:
    """The best rows of other labels in the window of each positive, in a cell."""
    dim = group.column("dim")[0].as_py()
    anchors, held, keys, labels = matrix(block, dim), matrix(group, dim), ids(group), _labels(group)
    found, order = scores(subset_sums(anchors), bit_planes(held)), np.argsort(keys, kind="stable")
    numbers, own, out = block.column("row").to_numpy(), _labels(block), []
    for i, positives in enumerate(block.column("positives").to_pylist()):
        others = order[labels[order] != own[i]]
        others = others[np.argsort(-found[others, i], kind="stable")]
        falling = -100 * found[others, i]
        for positive in positives:
            first = np.searchsorted(falling, -HIGH * positive["score"], "left")
            end = min(np.searchsorted(falling, -LOW * positive["score"], "right"), first + NEGATIVES)
            places = others[first:end]
            out.append((np.full(len(places), numbers[i]), np.full(len(places), positive["positive"]), keys[places], found[places, i]))
    columns = [np.concatenate(c) for c in zip(*out)]
    arrays = [pa.array(columns[0]), pa.array(columns[1]), arrow_ids(columns[2]), pa.array(columns[3])]
    return pa.table(arrays, names=_HARD)


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """For each anchor and each of its positives the ``NEGATIVES`` best rows of another label whose
    score is within ``LOW`` and ``HIGH`` hundredths of the positive's."""
    label = relabelled(F.col("vec_id"), F.col("label")).cast("long").alias("label")
    vectors = whole_vectors(rows.where(F.col("label").isNotNull()), FACTOR, label)
    anchors = vectors.where(is_anchor)
    near = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"), "positive")
    positives = on_grid(anchors, vectors, _positives, _NEAR).withColumn("nth", F.row_number().over(near))
    positives = stored(positives.where(F.col("nth") <= POSITIVES), "positives")
    per_anchor = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("positive", "score")).alias("positives"))
    hard = on_grid(anchors.join(per_anchor, "row"), vectors, _negatives, _HARD)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    named = ranked.join(positives.select("anchor", "positive", "anchor_id", "positive_id", F.col("score").alias("positive_score")), ["anchor", "positive"])
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
