"""Manifest, hard negatives and exact top-k against brute force, odd input included."""

import hashlib
import math
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import manifest, negatives, topk
from rowgate.llm import vectors as grid

SCHEMA = "vec_id long, embedding array<float>, label int, row string, dim string, part int, query int, rank int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1, 2, 3) for i, v, label in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    """Nulls, ties, a common vector, repeated rows, other lengths, labels of few rows."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 12).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    common = [0.25] * 12
    rows += [(1000 + i, common, i % 2) for i in range(300)]
    rows += [rows[0], rows[0], (None, common, 1), (None, rows[0][1], 0), (500, common, None), (501, None, 1), (502, [float("nan")] * 12, 1)]
    rows += [(503, [None] * 12, 1), (504, [float("inf")] + common[1:], 1), (505, [1e30] * 12, 1), (600, [0.5, -0.5], 0), (601, [0.5, 0.5], 0)]
    rows += [(602, [0.25, 0.25], 3), (700, [], 0), (701, [], 0), (702, [], 1), (800, [0.0] * 12, 2), (900, [-3.0] * 12, 9)]
    return rows


def usable(rows, factor):
    """Position, id, whole vector and label of the rows that take part."""
    for n, (i, v, label) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) and abs(x) < grid.LARGEST / factor for x in v):
            yield n, i, [math.floor(factor * float(np.float32(x))) for x in v], label


def by_score(row):
    score, vec_id = row[0], row[1]
    return -score, vec_id is None, vec_id or 0


def brute_top(rows, k):
    held, found = list(usable(rows, topk.FACTOR)), []
    for n, i, q, _ in held:
        if i is None or i % 100:
            continue
        scored = sorted(((sum(map(int.__mul__, q, v)), j) for m, j, v, _ in held if m != n and len(v) == len(q)), key=by_score)
        found += [(i, rank, j, s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def brute_negatives(rows):
    held, found = [], []
    for n, i, v, label in usable(rows, negatives.FACTOR):
        if label is not None:
            held.append((n, i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    for n, i, q, label in held:
        if i is None or i % 100:
            continue
        scored = [(sum(map(int.__mul__, q, v)), j, other == label) for m, j, v, other in held if m != n and len(v) == len(q)]
        scored.sort(key=by_score)
        others = [(s, j) for s, j, same in scored if not same]
        for p, j in [(s, j) for s, j, same in scored if same][:5]:
            inside = [(s, x) for s, x in others if 30 * p <= 100 * s <= 90 * p][:10]
            found += [(i, j, rank, x, p, s) for rank, (s, x) in enumerate(inside, 1)]
    return sorted(found, key=repr)


def as_sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(4096, 2048), (64, 3)])
def test_top_rows_are_those_of_brute_force(spark, odd, sizes, monkeypatch):
    monkeypatch.setattr(grid, "GROUP", sizes[0])
    monkeypatch.setattr(grid, "BLOCK", sizes[1])
    found = topk.top_rows(rows_of(spark, odd), F.col("vec_id") % 100 == 0, 7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert as_sorted(found) == brute_top(odd, 7)


@pytest.mark.parametrize("sizes", [(4096, 2048), (64, 3)])
def test_hard_negatives_are_those_of_brute_force(spark, odd, sizes, monkeypatch):
    monkeypatch.setattr(grid, "GROUP", sizes[0])
    monkeypatch.setattr(grid, "BLOCK", sizes[1])
    found = negatives.hard_negatives(rows_of(spark, odd), F.col("vec_id") % 100 == 0)
    assert as_sorted(found) == brute_negatives(odd)


def test_empty_tables_give_no_rows(spark):
    empty = rows_of(spark, [])
    assert topk.top_rows(empty, F.col("vec_id") % 100 == 0, 10).collect() == []
    assert negatives.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest.proof_report(docs).collect() == []


def test_a_query_stops_when_nothing_unseen_can_win():
    rng = np.random.default_rng(2)
    rows = rng.integers(-50, 50, (4000, 4))
    rows[17] = [900, -900, 900, -900]
    lists = topk.Lists(rows, np.arange(4000))
    found, scores, depth = lists.search(np.array([3, -2, 5, -1]), 1)
    assert (found.tolist(), scores.tolist()) == ([17], [9900]) and depth <= topk.FIRST
    for k in (1, 10, 4000):
        query = rng.integers(-9, 9, 4)
        found, scores, _ = lists.search(query, k, own=5)
        exact = rows @ query
        order = [i for i in np.lexsort((np.arange(4000), -exact)) if i != 5][:k]
        assert found.tolist() == order and scores.tolist() == exact[order].tolist()


@pytest.mark.parametrize("most", [1, 300, 1 << 27])
def test_look_ups_give_inner_products(most):
    rng = np.random.default_rng(most)
    anchors, rows = rng.integers(-most, most + 1, (7, 19)), rng.integers(-most, most + 1, (600, 19))
    assert (negatives.scores(negatives.subset_sums(anchors), negatives.bit_planes(rows)) == rows @ anchors.T).all()
    zero = np.zeros((3, 19), np.int64)
    assert not negatives.scores(negatives.subset_sums(anchors), negatives.bit_planes(zero)).any()


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in doc))


def brute_proofs(docs):
    """Whole trees in memory; documents are (doc_id, source, lang, n_chars, text)."""

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    langs = sorted({d[2] for d in docs}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        mine = sorted((d for d in docs if d[2] == lang), key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d)))
        trees.append((mine, tree([leaf_of(d) for d in mine])))
    crown, found = tree([t[-1][0] for _, t in trees]), []
    for branch, (mine, levels) in enumerate(trees):
        for rank, doc in enumerate(mine):
            folded, proof = leaf_of(doc), []
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 3 == 0 and doc[4] is not None:
                folded = leaf_of((*doc[:4], doc[4].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))))
            for place, part in ((rank, levels), (branch, crown)):
                for level in part[:-1]:
                    first = place // 8 * 8
                    run = level[first : first + 8]
                    proof += run[: place - first] + run[place - first + 1 :]
                    folded = h(*run[: place - first], folded, *run[place - first + 1 :])
                    place //= 8
            root = crown[-1][0]
            found.append((doc[0], leaf_of(doc), levels[-1][0], root, h(*proof), folded, folded == root))
    return sorted(found, key=repr)


def some_docs(n):
    rng = np.random.default_rng(n)
    langs = ["en", "fr", None, "", "é", "zh", "a", "b", "c", "d", "only"]
    docs = [(i, "s" if i % 3 else None, langs[min(int(rng.exponential(1.5)), 9)], i * 7 if i % 5 else None, f"Text é {i}" if i % 4 else None) for i in range(n)]
    return [*docs, (7, "s", "en", 1, ""), (7, "s", "en", 1, ""), (7, "s", "en", 1, "A" * 200_000), (None, None, None, None, None), (None, "x", "en", 0, "No Id"), (n, "s", "only", 1, "Alone")]


@pytest.mark.parametrize("n", [0, 9, 700])
def test_proofs_are_those_of_whole_trees(spark, n):
    docs = some_docs(n)
    columns = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], columns + ", digest string, tree string, rank int").repartition(5)
    assert as_sorted(manifest.proof_report(df)) == brute_proofs(docs)


def test_some_leaves_of_a_manifest_can_be_proved(spark):
    docs = some_docs(300)
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    fields = [F.col(c) for c in manifest.FIELDS]
    built = manifest.build(df.select(manifest.tree_name(F.col("lang")).alias("tree"), "doc_id", manifest.row_digest(*fields).alias("digest")))
    asked = built.leaves.where("doc_id between 40 and 60").select("tree", "rank", "doc_id", F.col("digest").alias("own"))
    found = built.prove(asked)
    assert found.count() == 21
    assert found.where((F.col("own") != F.col("digest")) | (manifest.fold(F.col("own"), F.col("path")) != F.col("root"))).isEmpty()
