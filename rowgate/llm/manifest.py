"""Merkle manifest of a dataset: a content-addressed graph of digests, and proofs found by descent.

A leaf is the sha256 of a row. The leaves of a tree, in order, are joined in runs of ``ARITY``: the
digest of a run is the sha256 of its children's hexadecimal digests, and so on up to one node. Each
node is kept as a record ``digest -> children``; the same digest is the same record wherever it is
met. The rows of each language form a tree, and the tops of these trees, in the order of the
languages, form one more.

A proof is found from the top: requests go down by the digits of their rank to the base ``ARITY``,
look each digest up among the records of its height, and collect the children that they do not
select. The requests below a node go down together, once, and part where their digits differ, so no
digest is looked up by all of them. The collected segments, reversed, are the proof from the leaf up.

Only digests move: texts are read in the first stage and hashed there. Ranks come from ranges of
(tree, id) and one count a range, so no task sees a whole tree.

Nulls in any column are hashed as ``-``, unlike empty texts; rows without a ``lang`` are a tree of
their own, the first. Rows that repeat a ``doc_id`` are leaves of their own, in the order of their
digests; rows without a ``doc_id`` come first in their tree. An empty table has no root and no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.common import stored

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENTS = "array<struct<left:string,right:string>>"


def row_digest(*fields: Column) -> Column:
    """sha256 of fields, each ``-`` if null and else its length in bytes, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0, among the ``n`` of their ``tree`` in ``order``; equal rows in any.

    Rows are sorted by ranges, and a number for each row tells its range and its place there. A
    tree has one count for each range that it reaches into."""
    sorted_rows = rows.withColumn("tie", F.monotonically_increasing_id())
    by = [tree, *order, "tie"]
    sorted_rows = sorted_rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie")
    placed = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ranges")
    runs = placed.groupBy("part", tree).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    mine = Window.partitionBy(tree)
    before = mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = stored(runs.select("part", tree, shift.alias("shift"), F.sum("n").over(mine).alias("n")), "shifts")
    ranks = placed.join(shifts, ["part", tree])
    return ranks.select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")


@dataclass(frozen=True)
class Forest:
    """Trees over ranked leaves. ``levels[h]`` holds the records of the nodes of height ``h + 1``:
    ``digest``, ``children`` and the node's place; ``tops`` has ``tree``, ``height`` and ``digest``."""

    levels: list[DataFrame]
    tops: DataFrame

    @property
    def height(self) -> int:
        return len(self.levels)


def grow(leaves: DataFrame) -> Forest:
    """The trees of ``leaves(tree, rank, n, digest)``: runs of ``ARITY`` become their digest while a
    tree has several nodes. ``n`` is the number of nodes of a tree at a height."""
    nodes = leaves.select("tree", "n", F.col("rank").alias("ordinal"), "digest")
    most = leaves.agg(F.max("n").alias("most")).first().most or 0
    tops, levels = nodes.where("n = 1"), []
    tops = tops.select("tree", F.lit(0).alias("height"), "digest")
    while most > 1:
        runs = nodes.where("n > 1").groupBy("tree", "n", F.floor(F.col("ordinal") / ARITY).alias("ordinal"))
        ordered = F.sort_array(F.collect_list(F.struct(F.col("ordinal").alias("at"), "digest")))  # ARITY at most
        level = runs.agg(F.transform(ordered, lambda c: c["digest"]).alias("children"))
        size = F.ceil(F.col("n") / ARITY).alias("n")
        level = level.select("tree", size, "ordinal", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children")
        levels.append(stored(level, f"records-{len(levels) + 1}"))
        nodes, most = levels[-1].drop("children"), -(-most // ARITY)
        tops = tops.union(nodes.where("n = 1").select("tree", F.lit(len(levels)).alias("height"), "digest"))
    return Forest(levels, stored(tops, "tops"))


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """Find ``requests(tree, rank, ...)``, one a leaf, from ``starts(tree, height, digest, path, ...)``.

    Returns the columns of the requests, the ``digest`` at their rank, ``path``, to which each step
    has added what stands left and right of the selected child, and the other columns of the starts."""
    asked = [c for c in requests.columns if c not in ("tree", "rank")]
    carried = [c for c in starts.columns if c not in ("tree", "height", "digest", "path")]
    parent, digit = F.floor(F.col("rank") / ARITY).alias("ordinal"), (F.col("rank") % ARITY).cast("int").alias("digit")
    picks = [requests.groupBy("tree", parent).agg(F.collect_list(F.struct(digit, *asked)).alias("picks"))]
    if forest.height > 1:
        picks[0] = stored(picks[0], "requests")
    for _ in range(1, forest.height):
        below = picks[-1].select("tree", F.col("ordinal").alias("rank"))
        picks.append(below.groupBy("tree", parent).agg(F.collect_list(F.struct(digit)).alias("picks")))

    def at(height: int) -> DataFrame:
        return starts.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("ordinal"), "digest", "path", *carried)

    found = None
    for height in range(forest.height, 0, -1):
        here = at(height) if found is None else found.union(at(height))
        records = forest.levels[height - 1].groupBy("digest").agg(F.first("children").alias("children"))
        met = here.join(records, "digest").join(picks[height - 1], ["tree", "ordinal"])
        met = met.select("tree", "ordinal", "path", "children", *carried, F.explode("picks").alias("pick"))
        chosen = F.col("pick.digit")
        left = F.array_join(F.slice("children", F.lit(1), chosen), "")
        right = F.array_join(F.slice("children", chosen + 2, F.lit(ARITY)), "")
        path = F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right"))))
        kept = [F.col(f"pick.{c}").alias(c) for c in asked] if height == 1 else []
        place = (F.col("ordinal") * ARITY + chosen).alias("ordinal")
        found = met.select("tree", place, F.get("children", chosen).alias("digest"), path.alias("path"), *carried, *kept)
    alone = requests.where("rank = 0").join(at(0).drop("ordinal"), "tree")  # the leaves that are trees
    columns = ["tree", "rank", "digest", "path", *carried, *asked]
    if found is None:
        return alone.select(*columns)
    return found.withColumnRenamed("ordinal", "rank").select(*columns).union(alone.select(*columns))


def proof(path: Column) -> Column:
    """The siblings of a path from the leaf up, as one text of digests."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path lead to."""
    return F.aggregate(F.reverse(path), leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (``tree``, ``rank``, ``digest`` and the kept columns), the ``forest`` over them and
    the ``crown`` over its tops, whose only tree has ``root`` as its top."""

    leaves: DataFrame
    forest: Forest
    crown: Forest
    branches: DataFrame

    @property
    def root(self) -> DataFrame:
        return self.crown.tops

    def prove(self, requests: DataFrame) -> DataFrame:
        """For ``requests(tree, rank, ...)``: their other columns, ``digest``, ``subroot``, ``root`` and ``path``."""
        start = self.root.select("tree", "height", "digest", F.array().cast(_SEGMENTS).alias("path"), F.col("digest").alias("root"))
        tops = descend(self.crown, start, self.branches.select("tree", "rank", "branch", "branch_height"))
        starts = tops.select(F.col("branch").alias("tree"), F.col("branch_height").alias("height"), "digest", "path", "root", F.col("digest").alias("subroot"))
        return descend(self.forest, stored(starts, "starts"), requests)


def tree_name(lang: Column) -> Column:
    """A name for the tree of a language that keeps their order, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows(tree, doc_id, digest, ...)``."""
    leaves = stored(numbered(rows, "tree", ["doc_id", "digest"]), "leaves")
    forest = grow(leaves)
    tops = forest.tops.select(F.lit("").alias("tree"), F.col("tree").alias("branch"), F.col("height").alias("branch_height"), "digest")
    branches = stored(numbered(tops, "tree", ["branch"]), "branches")
    return Manifest(leaves, forest, grow(branches), branches)


def tampered(doc_id: Column) -> Column:
    """Rows whose claim is tampered with in ``proof_report``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def proof_report(docs: DataFrame) -> DataFrame:
    """The proof of every row, and what its claim, where it is tampered with another leaf, leads to."""
    fields = [F.col(c) for c in FIELDS]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaf, claim = row_digest(*fields), row_digest(*fields[:-1], lowered)
    rows = docs.select(
        tree_name(F.col("lang")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("digest"),
        F.when(tampered(F.col("doc_id")), claim).alias("claim"),
    )
    manifest = build(rows)
    found = manifest.prove(manifest.leaves.select("tree", "rank", "doc_id", "claim"))
    folded = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("claim", "digest"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
