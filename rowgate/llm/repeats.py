"""Exact substring deduplication: bytes covered by a 100-byte string that also starts earlier.

Suffixes that share 100 bytes must meet, all others need not, so the suffix array is built in
parts. A string of ``LENGTH`` bytes is dealt out by the least hash of its ``GRAM``-byte grams: equal
strings have equal least hashes. Strings that start next to each other mostly share it, so a text
becomes *runs* of starts with one hash.

1. Hashes that occur once in the corpus cannot repeat; their runs end here. A batch of documents
   sends each hash it holds once, so a hash that very many documents hold is no hot group.
2. The bytes of the other runs meet by hash. Runs with equal bytes are merged first, in the batch
   and in the task; all but the earliest are removed whole. A hash with more than ``CROWD``
   different runs is dealt out anew by the hash of each of its strings.
3. What is left of a hash goes into a suffix array, by prefix doubling up to ``LENGTH`` bytes. From
   the common prefixes of neighbours and the previous and next smaller place in suffix order comes
   the longest previous factor of every start, up to ``LENGTH``. Starts whose factor reaches it are
   removed with the bytes they cover; the first of equal strings has a shorter factor and stays.

Earlier means a smaller ``doc_id``, or the same document and an earlier start. Null texts are empty;
texts under 100 bytes lose nothing. Rows that are equal in ``doc_id`` and text are one document, taken
once however many they are, and get the same result each; of different texts with one ``doc_id`` the order is that of their hashes;
no ``doc_id`` comes first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import id_and_text, shuffle_partitions, stored

LENGTH, GRAM = 100, 24
SPAN = LENGTH - GRAM + 1
CROWD = 100_000
_PIECE, _COMPARED = 1 << 20, 20_000
MOST_BROADCAST = 1_000_000  # keys of 8 bytes
_TIE = np.uint32(1 << 31)
RUN = np.dtype([("hash", "<u8"), ("at", "<u4"), ("n", "<u4")])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the ``GRAM`` (24) bytes from each place on."""
    one, power = data.astype(np.uint64) + np.uint64(1), _BASE
    sums = {1: one}
    for n in (1, 2, 4, 8):
        sums[2 * n] = sums[n][:-n] * power + sums[n][n:]
        power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
        if n == 4:
            power8 = power
    found = sums[16][:-8] * power8 + sums[8][16:]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0x94D049BB133111EB)
    found ^= found >> np.uint64(32)
    return found


def _sliding(values: np.ndarray, pick) -> np.ndarray:
    """``pick`` over ``SPAN`` values from each place on."""
    width = 1
    while 2 * width <= SPAN:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = SPAN - width
    return pick(values[:-rest], values[rest:]) if rest else values


def find_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs over texts laid end to end: hash, start, strings, and whether one may repeat inside.

    ``ends`` are the places where the texts end. No string crosses an end."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), none, none, np.zeros(0, bool)
    grams = _gram_hashes(data)
    least = _sliding(grams, np.minimum)
    bounds = np.r_[0, ends]
    text = np.repeat(np.arange(len(ends)), np.diff(bounds))[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= bounds[1:][text]
    breaks = np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])]
    starts = np.flatnonzero(breaks)
    sizes = np.diff(np.r_[starts, len(least)])
    # The grams that are least in some string; two equal ones close together are in one string.
    floor = np.where(inside, least, np.uint64(0))
    pad = np.zeros(SPAN - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.r_[pad, floor, pad], np.maximum)[: len(grams)] == grams)
    close = (grams[chosen[1:]] == grams[chosen[:-1]]) & (np.diff(chosen) < SPAN)
    both = np.zeros(len(least) + 1, np.int64)
    np.add.at(both, np.clip(chosen[1:][close] - SPAN + 1, 0, len(least)), 1)
    np.add.at(both, np.clip(chosen[:-1][close] + 1, 0, len(least)), -1)
    tied = np.maximum.reduceat(np.cumsum(both[:-1]) > 0, starts)
    kept = inside[starts]
    return least[starts][kept], starts[kept], sizes[kept], tied[kept]


def _pieces(keys: list[int], texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of many texts, about ``_PIECE`` bytes at a time; long texts in overlapping parts."""
    waiting, size = [], 0
    for key, text in zip(keys, texts):
        for first in range(0, max(1, len(text) - LENGTH + 1), _PIECE):
            part = text[first : first + _PIECE + LENGTH - 1]
            if len(part) >= LENGTH:
                waiting.append((key, first, part))
                size += len(part)
        if size >= _PIECE:
            yield _together(waiting)
            waiting, size = [], 0
    if waiting:
        yield _together(waiting)


def _together(parts: list[tuple[int, int, bytes]]):
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    ends = np.cumsum([len(p) for _, _, p in parts])
    hashes, starts, sizes, tied = find_runs(data, ends)
    which = np.searchsorted(ends, starts, "right")
    keys = np.array([k for k, _, _ in parts], np.int64)[which]
    at = starts - np.r_[0, ends[:-1]][which] + np.array([f for _, f, _ in parts], np.int64)[which]
    return keys, hashes, at, sizes, tied


def _records(hashes: np.ndarray, at: np.ndarray, n: np.ndarray, tied: np.ndarray) -> np.ndarray:
    found = np.empty(len(hashes), RUN)
    found["hash"], found["at"], found["n"] = hashes, at, n.astype(np.uint32) | np.where(tied, _TIE, np.uint32(0))
    return found


def _table(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _by_key(keys: np.ndarray, records: np.ndarray) -> tuple[list[int], list[bytes]]:
    order = np.argsort(keys, kind="stable")
    keys, records = keys[order], records[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    bounds = [*starts.tolist(), len(keys)]
    return keys[starts].tolist(), [records[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def repeated_runs(texts: DataFrame) -> DataFrame:
    """``dk`` and ``runs`` (packed ``RUN`` records): the runs of ``texts(dk, text)`` whose hash
    occurs more than once."""
    spark = texts.sparkSession
    parts = max(shuffle_partitions(spark), texts.rdd.getNumPartitions())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_pieces(batch.column(0).to_pylist(), [t.as_buffer().to_pybytes() for t in batch.column(1)]))
            if not found:
                continue
            keys, hashes, at, n, tied = (np.concatenate(c) for c in zip(*found))
            del found
            distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            counts = counts + np.bincount(inverse, tied, len(distinct)).astype(np.int64)
            again = (counts > 1)[inverse]
            records = _records(hashes, at, n, tied)
            # Known to repeat: they need no answer, so where they go does not matter.
            owners, packed = _by_key(keys[again], records[again])
            known = {"part": [k % parts for k in owners], "dk": owners, "keys": [None] * len(owners), "runs": packed}
            # Of a hash that repeats here others are told; a single one asks.
            told = distinct[counts > 1]
            rows = []
            for hashes_, keys_, records_ in ((told, None, told), (hashes[~again], keys[~again], records[~again])):
                to = (hashes_ % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                used, first = np.unique(to[order], return_index=True)
                for part, mine in zip(used.tolist(), np.split(order, first[1:])):
                    rows.append((part, None, b"" if keys_ is None else keys_[mine].tobytes(), records_[mine].tobytes()))
            for part, dk, mine, packed_ in rows:
                known["part"].append(part)
                known["dk"].append(dk)
                known["keys"].append(mine)
                known["runs"].append(packed_)
            yield _table({"part": pa.array(known["part"], pa.int32()), "dk": pa.array(known["dk"], pa.int64()), "keys": pa.array(known["keys"], pa.binary()), "runs": pa.array(known["runs"], pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, told, keys, asked = None, [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if asked:
                owner, runs = np.concatenate(keys), np.concatenate(asked)
                hashes = runs["hash"]
                everything = np.concatenate([hashes, *told, *told])
                _, inverse, counts = np.unique(everything, return_inverse=True, return_counts=True)
                again = counts[inverse[: len(hashes)]] > 1
                raw = runs[again].tobytes()
                packed = [raw[at : at + RUN.itemsize] for at in range(0, len(raw), RUN.itemsize)]
                yield _table({"dk": pa.array(owner[again], pa.int64()), "runs": pa.array(packed, pa.binary())})
            told.clear(), keys.clear(), asked.clear()

        for batch in batches:
            passed = {"dk": [], "runs": []}
            for to, dk, mine, runs in zip(*(c.to_pylist() for c in batch.columns)):
                if to != part:
                    yield from flush()
                    part = to
                if mine is None:
                    passed["dk"].append(dk)
                    passed["runs"].append(runs)
                elif mine == b"":
                    told.append(np.frombuffer(runs, "<u8"))
                else:
                    keys.append(np.frombuffer(mine, "<i8"))
                    asked.append(np.frombuffer(runs, RUN))
            yield _table({"dk": pa.array(passed["dk"], pa.int64()), "runs": pa.array(passed["runs"], pa.binary())})
        yield from flush()

    dealt = texts.mapInArrow(deal, "part int, dk long, keys binary, runs binary")
    met = dealt.repartition(parts, "part").sortWithinPartitions("part")
    return met.mapInArrow(answer, "dk long, runs binary")


def _common(data: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many of the ``LENGTH`` bytes from each of two places on are equal at their beginning."""
    found, reach = np.full(len(one), LENGTH, np.int64), np.arange(LENGTH)
    for at in range(0, len(one), _COMPARED):
        some = slice(at, at + _COMPARED)
        unequal = data[one[some, None] + reach] != data[other[some, None] + reach]
        found[some] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), LENGTH)
    return found


def _shared_with_smaller(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """What each suffix shares with the nearest one before it in suffix order that has a smaller
    place; ``common`` is what it shares with its neighbour. Everyone steps over neighbours of larger
    places, and over what these have stepped over, so a chain is halved each time."""
    before, shared = np.arange(len(place)) - 1, common.copy()
    moving = np.flatnonzero((before >= 0) & (place[np.maximum(before, 0)] > place))
    while len(moving):
        over = before[moving]
        steps, least = before[over], np.minimum(shared[moving], shared[over])
        before[moving], shared[moving] = steps, least
        moving = moving[(steps >= 0) & (place[np.maximum(steps, 0)] > place[moving])]
    shared[before < 0] = 0
    return shared


def previous_factors(data: np.ndarray, starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The longest previous factor at each of ``starts``, up to ``LENGTH`` bytes, where ``place``
    orders the starts. Suffixes are put in order by prefix doubling: ranks of 8, 16, 32, 64 and then
    100 bytes, equal ones by place."""
    if not len(starts):
        return np.zeros(0, np.int64)
    padded = np.r_[data, np.zeros(LENGTH, np.uint8)]
    wide, n = padded.astype(np.uint64), len(data)
    rank = np.zeros(n, np.uint64)
    for byte in range(8):
        rank |= wide[byte : byte + n] << np.uint64(56 - 8 * byte)
    del wide
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    for step in (8, 16, 32, LENGTH - 64):
        ahead = np.zeros(n, np.uint64)
        ahead[: max(0, n - step)] = rank[step:] + np.uint64(1)
        rank = np.unique(rank * np.uint64(n + 2) + ahead, return_inverse=True)[1].astype(np.uint64)
    rank = rank[starts]
    order = np.lexsort((place, rank))
    ranked, placed, at = rank[order], place[order], starts[order]
    common = np.full(len(order), LENGTH, np.int64)
    unlike = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
    common[unlike], common[0] = _common(padded, at[unlike - 1], at[unlike]), 0
    earlier = _shared_with_smaller(placed, common)
    later = _shared_with_smaller(placed[::-1], np.r_[0, common[:0:-1]])[::-1]
    found = np.empty(len(order), np.int64)
    found[order] = np.maximum(earlier, later)
    return found


def _removed(segments: list[tuple[int, int, int, int, bytes, bool]]) -> Iterator[tuple[int, int, int, int]]:
    """Spans ``(doc_id, dk, start, stop)`` of one task's ``(hash, doc_id, dk, at, bytes, tied)``."""
    first: dict[tuple[int, bytes], list] = {}
    for hash_, doc, dk, at, data, tied in segments:
        held = first.setdefault((hash_, data), [(doc, dk, at), tied])
        if (doc, dk, at) == held[0]:
            continue
        later = max(held[0], (doc, dk, at))
        held[0] = min(held[0], (doc, dk, at))
        yield later[0], later[1], later[2], later[2] + len(data)
    shared: dict[int, int] = {}
    for hash_, _ in first:
        shared[hash_] = shared.get(hash_, 0) + 1
    open_ = [(place, data) for (hash_, data), (place, tied) in first.items() if tied or shared[hash_] > 1]
    if not open_:
        return
    open_.sort()
    sizes = np.array([len(d) for _, d in open_])
    counts = sizes - LENGTH + 1
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    within = np.arange(counts.sum()) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
    which = np.repeat(np.arange(len(open_)), counts)
    # Runs of one document do not overlap in their starts, so the order of runs is that of places.
    factors = previous_factors(np.frombuffer(b"".join(d for _, d in open_), np.uint8), begin[which] + within, np.arange(len(which)))
    again = factors >= LENGTH
    edge = np.flatnonzero(np.diff(np.r_[0, again.astype(np.int8), 0]))
    cuts = np.cumsum(counts)
    for a, b in edge.reshape(-1, 2).tolist():
        while a < b:
            run = int(which[a])
            end = min(b, int(cuts[run]))
            doc, dk, at = open_[run][0]
            yield doc, dk, at + int(within[a]), at + int(within[end - 1]) + LENGTH
            a = end


_SEGMENT = "hash long, doc_id long, dk long, at int, n int, bytes binary, tied boolean"
_SPANS = "doc_id long, dk long, start int, stop int"
_TASK_BYTES = 1 << 20


def _segments(touched: DataFrame, crowded: frozenset[int], counting: bool) -> DataFrame:
    """The runs with their bytes, equal ones of a batch merged; those merged away have no bytes.
    With ``counting`` only the hashes of the former."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[tuple[int, bytes], list] = {}
            later: list[tuple[int, int, int, int]] = []

            def add(hash_: int, place: tuple[int, int, int], data: bytes, tied: bool) -> None:
                held = first.setdefault((hash_, data), [place, tied])
                if place != held[0]:
                    later.append((*max(held[0], place), len(data)))
                    held[0] = min(held[0], place)

            for doc, dk, text, packs in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                runs = np.frombuffer(b"".join(packs), RUN)
                sizes, tied = (runs["n"] & ~_TIE).tolist(), (runs["n"] & _TIE > 0).tolist()
                for hash_, at, n, tie in zip(runs["hash"].view("<i8").tolist(), runs["at"].tolist(), sizes, tied):
                    if hash_ not in crowded:
                        add(hash_, (doc, dk, at), data[at : at + n + LENGTH - 1], tie)
                        continue
                    for start in range(at, at + n):
                        string = data[start : start + LENGTH]
                        add(xxhash.xxh64_intdigest(string) - (1 << 63), (doc, dk, start), string, False)
            if counting:
                yield _table({"hash": pa.array([h for h, _ in first], pa.int64())})
                continue
            rows = [(h, *place, len(d) - LENGTH + 1, d, tied) for (h, d), (place, tied) in first.items()]
            rows += [(dk ^ at, doc, dk, at, n, None, False) for doc, dk, at, n in _joined(later)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_())
            for at in range(0, len(rows), 20_000):
                columns = zip(*rows[at : at + 20_000])
                yield _table(dict(zip(("hash", "doc_id", "dk", "at", "n", "bytes", "tied"), (pa.array(c, t) for c, t in zip(columns, types)))))

    return touched.select("doc_id", "dk", "text", "runs").mapInArrow(run, "hash long" if counting else _SEGMENT)


def _joined(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans ``(doc_id, dk, at, length)`` with those that touch put together."""
    found: list[list[int]] = []
    for doc, dk, at, length in sorted(spans):
        last = found[-1] if found else None
        if last and last[:2] == [doc, dk] and at <= last[2] + last[3]:
            last[3] = max(last[3], at + length - last[2])
        else:
            found.append([doc, dk, at, length])
    return [tuple(x) for x in found]


def _repeated_spans(segments: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            found = _joined([(doc, dk, a, b - a) for doc, dk, a, b in [*_removed(held), *passed]])
            held.clear(), passed.clear()
            columns = list(zip(*((doc, dk, a, a + n) for doc, dk, a, n in found))) or [()] * 4
            yield _table(dict(zip(("doc_id", "dk", "start", "stop"), (pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))))))

        passed: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for hash_, doc, dk, at, n, data, tied in zip(*(c.to_pylist() for c in batch.columns)):
                if hash_ != last and size >= _TASK_BYTES:
                    yield from flush()
                    size = 0
                last = hash_
                if data is None:
                    passed.append((doc, dk, at, at + n))
                else:
                    held.append((hash_, doc, dk, at, data, tied))
                    size += len(data)
        yield from flush()

    return segments.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, _SPANS)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without its spans."""
    for batch in batches:
        rows = []
        for doc, dk, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data, kept, at, removed, merged = text.encode(), [], 0, 0, 0
            for span in spans:
                if span["stop"] <= at:
                    continue
                merged += span["start"] > at or at == 0
                kept.append(data[at : span["start"]])
                removed += span["stop"] - max(at, span["start"])
                at = span["stop"]
            kept.append(data[at:])
            rows.append((doc, dk, len(data), removed, merged, b"".join(kept)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*rows)) or [()] * 6
        yield _table(dict(zip(("doc_id", "dk", "n_bytes", "n_removed", "n_spans", "kept"), (pa.array(c, t) for c, t in zip(columns, types)))))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay (null
    where none were removed), with their sha256 as ``kept_sha256``."""
    lowest = -(2**63)
    texts = id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(lowest)))
    texts = texts.withColumn("dk", F.xxhash64("doc_id", "text"))
    copies = stored(texts.groupBy("dk").agg(F.count("*").alias("times")).where("times > 1"), "copies")
    n = copies.count()
    if n:  # of equal rows one is taken, and its result given out as often as they are
        known = F.broadcast(copies) if n <= MOST_BROADCAST else copies
        single = texts.join(known, "dk", "left_anti")
        single = single.unionByName(texts.join(known, "dk", "left_semi").dropDuplicates(["dk"]))
        found = _without_repeats(single).join(known, "dk", "left")
        found = found.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("times", F.lit(1).cast("long")))))
    else:
        found = _without_repeats(texts)
    id_ = F.when(F.col("doc_id") != lowest, F.col("doc_id")).alias("doc_id")
    return found.select(id_, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")


def _without_repeats(texts: DataFrame) -> DataFrame:
    """The result for ``texts(doc_id, text, dk)``, with ``dk``."""
    runs = repeated_runs(texts.select("dk", "text")).groupBy("dk").agg(F.collect_list("runs").alias("runs"))
    joined = texts.join(runs, "dk", "left")
    alone = F.col("runs").isNull()
    joined = joined.select(
        "doc_id", "dk", "runs", F.when(~alone, F.col("text")).alias("text"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.when(alone, F.sha2("text", 256)).alias("sha"),
    )
    joined = stored(joined, "touched")
    touched, rest = joined.where("runs is not null"), joined.where("runs is null")
    counts = _segments(touched, frozenset(), True).groupBy("hash").agg(F.count("*").alias("n"))
    crowded = frozenset(r.hash for r in counts.where(F.col("n") > CROWD).select("hash").collect())  # one per CROWD runs at most
    spans = _repeated_spans(_segments(touched, crowded, False))
    spans = spans.groupBy("doc_id", "dk").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    own = touched.select("doc_id", "dk", "text").join(spans, ["doc_id", "dk"], "left")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    cut = own.select("doc_id", "dk", "text", F.coalesce("spans", none).alias("spans"))
    cut = cut.mapInArrow(_kept, "doc_id long, dk long, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    whole = rest.select("doc_id", "dk", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), F.col("sha").alias("kept_sha256"))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).unionByName(whole)


def repeat_report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
