"""Random tokens of each alphabet are found, the allow-list hides what it touches, long texts are linear."""

import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.llm import secrets

ALPHABETS = {
    "hex": "0123456789abcdef",
    "one case": string.ascii_lowercase + string.digits,
    "upper": string.ascii_uppercase + string.digits,
    "letters and digits": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
}


def added(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find_secrets(df).select("doc_id", "added", F.expr("filter(base, b -> b.kind = 2)").alias("hex"))
    return {r.doc_id: r.added or r.hex for r in found.collect()}


@pytest.mark.parametrize("kind", ALPHABETS)
def test_random_tokens_are_found(spark, kind):
    rng, shares = np.random.default_rng(len(kind)), []
    for length in (20, 24, 32):
        words = ["see " + "".join(rng.choice(list(ALPHABETS[kind]), length)) + " there" for _ in range(300)]
        found = added(spark, words)
        shares.append(sum(1 for spans in found.values() if any(s.start <= 5 and s.stop >= 4 + length - 1 for s in spans)) / 300)
    assert min(shares) >= 0.95, shares


def test_plain_words_and_allowed_strings_are_left_alone(spark):
    token = "q7Zp2Xv9Lk4Rt8Wm3Bn6"
    texts = [
        "page-of-a-page-of-a-page-2", "zzzzzzzzzzzzzzzzzzzz1111", "550e8400-e29b-41d4-a716-446655440000",
        "example" + token[:12], "example-" + token, token + "xxxxxx", "0123456789abcdefghij", "wordswordswordswordswords",
    ]
    found = added(spark, texts)
    assert [bool(found[i]) for i in range(len(texts))] == [False, False, False, False, True, True, False, False]


def test_spans_of_many_matches(spark):
    """Positions behind very many matches, and time that grows with the text."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("0123456789abcdef"), 26)) for _ in range(8000)]
    text = " é ".join(words)
    start = time.time()
    row = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(s.start, s.stop) for s in row.base] == [(29 * i, 29 * i + 26) for i in range(8000)] and not row.added
    assert time.time() - start < 20
