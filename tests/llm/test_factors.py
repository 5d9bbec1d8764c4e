"""Longest previous factors against brute force, and very many equal rows."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import repeats


@pytest.mark.parametrize("letters,n", [(1, 260), (2, 700), (4, 700), (250, 400)])
def test_factors_are_the_longest_ones(letters, n):
    rng = np.random.default_rng(letters)
    block = rng.integers(0, letters, 150).astype(np.uint8)
    data = np.concatenate([rng.integers(0, letters, n).astype(np.uint8), block, rng.integers(0, letters, 60).astype(np.uint8), block])
    starts = np.arange(len(data) - repeats.LENGTH + 1)
    place = rng.permutation(len(starts)) if letters != 4 else np.arange(len(starts))
    strings = [data[i : i + repeats.LENGTH] for i in starts]
    expected = []
    for i in starts:
        others = [np.argmax(np.r_[strings[i] != strings[j], True]) for j in starts if place[j] < place[i]]
        expected.append(max(others, default=0))
    assert repeats.previous_factors(data, starts, place).tolist() == expected


def test_equal_rows_are_taken_once(spark):
    rng = np.random.default_rng(1)
    common = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 60))
    long = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 500))
    rows = [(1, common + " one " + long), (2, common + " two"), (2, common + " three")]
    single = {(r.doc_id, r.kept_sha256): r for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    many = spark.createDataFrame(rows, "doc_id long, text string").crossJoin(spark.range(10_000)).drop("id")
    start = time.time()
    found = repeats.without_repeats(many).groupBy("doc_id", "kept_sha256", "n_removed", "n_spans", "n_bytes").agg(F.count("*").alias("n")).collect()
    assert time.time() - start < 60
    assert len(found) == 3 and all(r.n == 10_000 and r.n_removed == single[r.doc_id, r.kept_sha256].n_removed for r in found)
