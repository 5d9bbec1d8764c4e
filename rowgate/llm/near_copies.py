"""Near copies for the pipeline: texts whose sets of 5-word shingles have a Jaccard likeness of 0.8 or more.

The first candidates are the links of ``simhash``: fingerprints of 4-word shingles within four bits, by
its segment counts, grid and count of bits. Pairs at 0.8 differ in about ten of the 64 bits and in up to
eighteen; parts short enough for such a pigeonhole hold next to no bits, so at that distance the grid
would compare nearly everything. The other candidates are therefore texts that agree in one of ``BANDS``
bands of ``ROWS`` minima of hashes: a pair at 0.8 is missed with a chance of (1 - 0.8 ** 4) ** 32, under
one in ten million. Every candidate is checked on the whole sets, so no link is an estimate.

Texts with equal sets are one node from the start. In each band group all nodes are compared with
one of them, the one that meets most others over all its bands, as the text others were made from
does. Nodes of groups that are still apart then name their partners by an exact prefix filter: with
the shingles of a set ordered from rare to common, two sets at 0.8 share one of the first fifth of
each, at a place that leaves enough of both behind it. What is unlike its group has shingles of its
own there, so a group costs about as many checks as it has members, not one for each pair.

Words are set apart by white space, letters of ASCII compared without case, as in ``simhash``. A
text under five words is one shingle; texts without words are copies of each other only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm import simhash
from rowgate.llm.common import connected_components, id_and_text, stored

SHINGLE, SEED, BANDS, ROWS = 5, 42, 32, 4
_CHUNK = 8_192
_RANDOM = np.random.default_rng(11)
_MASKS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, np.uint32)[:, None]
_FACTORS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, np.uint32)[:, None] | np.uint32(1)


def shingles(text: str) -> np.ndarray:
    """The different hashes of all runs of five words, in order."""
    data = b" ".join(text.encode().lower().split())
    if not data:
        return np.zeros(0, np.uint64)
    blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = [0, *(blanks + 1).tolist()], [*blanks.tolist(), len(data)]
    if len(starts) < SHINGLE:
        starts, ends = [0], [len(data)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(data[a:b], SEED) for a, b in zip(starts, ends[min(SHINGLE, len(ends)) - 1 :])], np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed 64-bit key for each band of minima; none for an empty set."""
    if not len(hashes):
        return []
    low = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    minima = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _CHUNK):
        np.minimum(minima, ((low[at : at + _CHUNK] ^ _MASKS) * _FACTORS).min(axis=1), out=minima)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), seed) for seed, band in enumerate(minima.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _node(hashes: np.ndarray) -> int:
    """The name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column(1).to_pylist()
            sets = [shingles(t) for t in texts]
            columns = [
                part.column(0),
                pa.array([_node(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
                pa.array(np.array([simhash.fingerprint(t) for t in texts], np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "keys", "fp"])


def _simhash_links(prints: DataFrame, bits: int) -> DataFrame:
    """``(a, b)``: nodes whose texts have fingerprints that ``simhash`` links, or equal ones. A
    fingerprint goes by the name of the smallest node that has it."""
    named = stored(prints.groupBy("fp").agg(F.min("node").alias("name")), "fingerprints")
    same = prints.join(named, "fp").where("node <> name").select(F.col("name").alias("a"), F.col("node").alias("b")).distinct()
    found = simhash.links(named.select("fp"), bits)
    one = named.select(F.col("fp").alias("a"), F.col("name").alias("one"))
    other = named.select(F.col("fp").alias("b"), F.col("name").alias("other"))
    within = found.join(one, "a").join(other, "b").where("one <> other").select(F.col("one").alias("a"), F.col("other").alias("b"))
    return same.union(within)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            sets = [shingles(t.as_py()) for t in batch.column(1).slice(at, 256)]
            nodes, held = pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([nodes, held], names=["node", "hashes"])


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have a likeness of 0.8 or more, by whole numbers."""
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("hashes").alias("other"))
    common = F.size(F.array_intersect("one", "other"))
    return pairs.distinct().join(one, "a").join(other, "b").where(common * 9 >= (F.size("one") + F.size("other")) * 4).select("a", "b")


def _near_sizes(n: str, m: str):
    """Whether sets of these sizes can have a likeness of 0.8."""
    return (F.col(n) * 5 >= F.col(m) * 4) & (F.col(m) * 5 >= F.col(n) * 4)


def _hub_links(keyed: DataFrame) -> DataFrame:
    """``(a, b)``: in each band group every node beside the node that meets most others."""
    met = keyed.groupBy("node").agg(F.sum("members").alias("met"))
    hubs = keyed.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("hub"))
    spokes = keyed.join(hubs, "key").where(F.col("node") != F.col("hub.node")).withColumn("hub_n", F.col("hub.n"))
    return spokes.where(_near_sizes("n", "hub_n")).select(F.col("hub.node").alias("a"), F.col("node").alias("b"))


def _prefixes(sets: DataFrame) -> DataFrame:
    """``token``, ``node``, ``label``, ``n`` and ``place``: the first fifth of each set of ``sets(node,
    label, hashes)`` from rare to common, but for shingles that no other set has."""
    tokens = stored(sets.select("node", "label", F.size("hashes").alias("n"), F.explode("hashes").alias("token")), "tokens")
    shared = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    mine = tokens.join(shared, "token").groupBy("node", "label", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("shared"))
    own = F.col("n") - F.size("shared")  # they come first
    first = mine.select("*", own.alias("own"), F.greatest(F.floor(F.col("n") / 5) + 1 - own, F.lit(0)).cast("int").alias("taken"))
    first = first.select("node", "label", "n", "own", F.posexplode(F.slice("shared", F.lit(1), F.col("taken"))).alias("at", "x"))
    return first.select("x.token", "node", "label", "n", (F.col("own") + F.col("at")).alias("place"))


def _partners(index: DataFrame) -> DataFrame:
    """``(a, b)``: nodes with different labels that share a token of their prefixes, with enough of
    both sets from there on."""
    other = index.select("token", *[F.col(c).alias(f"other_{c}") for c in ("node", "label", "n", "place")])
    left = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    enough = left * 9 >= (F.col("n") + F.col("other_n")) * 4
    apart = (F.col("label") < F.col("other_label")) & _near_sizes("n", "other_n") & enough
    return index.join(other, "token").where(apart).select(F.col("node").alias("a"), F.col("other_node").alias("b"))


def groups(docs: DataFrame, bits: int = simhash.BITS) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest ``doc_id`` reachable over links of near copies.
    ``bits`` is what fingerprints may differ in to be candidates of the SimHash step."""
    prints = stored(id_and_text(docs).mapInArrow(_prints, "doc_id long, node long, n int, keys array<long>, fp long"), "shingle-prints")
    nodes = prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    nodes = stored(nodes, "shingle-nodes")
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "n")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    keyed = stored(keyed.join(sizes, "key"), "band-groups")
    spokes = stored(_hub_links(keyed).distinct(), "spokes")
    close = stored(_simhash_links(prints, bits), "simhash-links")
    met = keyed.select("node").union(close.select("a")).union(close.select("b")).distinct()
    needed = nodes.join(met, "node", "left_semi").select(F.col("first").alias("doc_id"))
    texts = id_and_text(docs).join(needed, "doc_id", "left_semi")
    sets = stored(texts.mapInArrow(_sets, "node long, hashes array<long>").dropDuplicates(["node"]), "shingle-sets")

    links = stored(_alike(close.union(spokes), sets), "near-links")
    found = connected_components(links).select(F.col("id").alias("node"), F.col("component").alias("label"))
    named = sets.select("node").join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    named = stored(keyed.join(named, "node").select("key", "node", "label"), "band-labels")
    apart = named.groupBy("key").agg(F.min("label").alias("one"), F.max("label").alias("other")).where("one < other")
    unsettled = named.join(apart.select("key"), "key", "left_semi").select("node", "label").distinct()
    index = stored(_prefixes(sets.join(unsettled, "node")), "prefixes")
    more = stored(_alike(_partners(index), sets), "near-links")

    labels = connected_components(links.union(more))
    classes = nodes.join(labels, nodes.node == labels.id, "left").select("node", "first", F.coalesce("component", "node").alias("label"))
    classes = stored(classes, "classes")
    smallest = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    return prints.select("doc_id", "node").join(classes.join(smallest, "label").select("node", "component_id"), "node").select("doc_id", "component_id")


def one_per_group(docs: DataFrame, bits: int = simhash.BITS) -> DataFrame:
    """``docs``, all columns, without near copies: of each group (of ``groups``) the smallest ``doc_id``
    stays, and one row of those that repeat it. Rows without a ``doc_id`` stay."""
    found = groups(docs.where(F.col("doc_id").isNotNull()), bits)
    first = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").select(*[docs[c] for c in docs.columns]).dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
