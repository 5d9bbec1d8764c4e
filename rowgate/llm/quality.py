"""Quality classifier with supervised subword embeddings.

A word is the mean of learned vectors for itself and each of its character n-grams, taken over bytes
with a blank before and after the word. The items of a document are its words and its pairs of words
in a row, which have vectors of their own; all are hashed into ``BUCKETS`` rows. A word that follows
itself is one more item, whatever the word. A document is the
mean of its items, and a softmax over two classes gives its score. The vectors are trained by
stochastic gradient descent in numpy on at most ``TRAIN_DOCS`` labelled documents, those whose ids
hash lowest; what is gathered of one is at most a number for each bucket. Every document is scored on
its whole text.

The class scores are linear in the mean, so scoring needs one number per bucket. Bytes of some texts
at a time are hashed as arrays, with no look-up per word, and memory is bounded by ``BATCH_BYTES``: a
longer text is cut at blanks, or within a longer run of other bytes, and nothing else is lost there
than the pair of words or the n-grams across the cut. Null and empty texts get the score of the bias alone. Where a document has several
labels the lowest counts; without any labels every score is one half. Repeated rows are scored one by
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, DIMENSIONS, GRAMS = 1 << 18, 8, (2, 3, 4)
TRAIN_DOCS, EPOCHS, RATE = 1_500, 6, 2.0
ACCEPTED = 0.7
HELD_OUT = 2
BATCH_BYTES = 500_000
_STEP, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)  # an odd number and its inverse
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` for i below n, modulo 2**64."""
    if len(_POWERS.get(base, ())) < n:
        found = np.full(n, base, np.uint64)
        found[0] = 1
        _POWERS[base] = np.multiply.accumulate(found)
    return _POWERS[base][:n]


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """Hashes as buckets."""
    values = (values + np.uint64(seed)) * np.uint64(_STEP)
    return ((values ^ (values >> np.uint64(29))) * np.uint64(_STEP) >> np.uint64(40)).astype(np.int64) % BUCKETS


class Items:
    """The items of some texts: ``buckets`` of all features, each of the item numbered in ``item``,
    ``text`` of each item, and ``shares``, the weight of a feature in its item."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        data = np.where((joined >= 9) & (joined <= 13), np.uint8(32), joined)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends_of_texts = np.cumsum(lengths + 1)
        blank = data == 32
        starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        wide, sums = data.astype(np.uint64), np.zeros(len(data) + 1, np.uint64)
        np.cumsum(wide * _powers(_STEP, len(data)), out=sums[1:])
        words = (sums[ends] - sums[starts]) * _powers(_BACK, len(data))[starts]
        of_word = np.searchsorted(ends_of_texts, starts, "right")
        buckets, items = [_mixed(words, 1)], [np.arange(len(words))]
        inside = np.cumsum(blank)  # words are told apart by the blanks before them
        place = np.zeros(inside[-1] + 1 if len(inside) else 1, np.int64)
        place[inside[starts]] = np.arange(len(starts))
        gram = wide
        for n in GRAMS:  # windows with blanks at their ends at most, and a byte of a word
            gram = gram[: len(data) - n + 1] * np.uint64(257) + wide[n - 1 :] if n > 2 else wide[:-1] * np.uint64(257) + wide[1:]
            first, last = np.arange(len(gram)), np.arange(n - 1, len(data))
            held = inside[last - 1] - inside[first] == 0
            held &= ~(blank[first] & blank[last]) if n == 2 else ~blank[1 : 1 + len(gram)]
            at = np.flatnonzero(held)
            buckets.append(_mixed(gram[at], n))
            items.append(place[inside[at]])
        counts = np.bincount(np.concatenate(items), minlength=len(words)).astype(np.float64)
        pairs = np.flatnonzero(of_word[1:] == of_word[:-1])
        buckets.append(_mixed(words[pairs] * np.uint64(_STEP) + words[pairs + 1], 9))
        items.append(len(words) + np.arange(len(pairs)))
        again = pairs[words[pairs] == words[pairs + 1]]
        buckets.append(np.zeros(len(again), np.int64))
        items.append(len(words) + len(pairs) + np.arange(len(again)))
        self.buckets, self.item = np.concatenate(buckets), np.concatenate(items)
        self.text = np.concatenate([of_word, of_word[pairs], of_word[again]])
        self.shares = 1 / np.append(counts, np.ones(len(pairs) + len(again)))
        self.n_items = np.bincount(self.text, minlength=len(texts))


def slices(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > BATCH_BYTES:
        cut = text.rfind(b" ", at, at + BATCH_BYTES)
        cut = cut if cut > at else at + BATCH_BYTES
        yield text[at:cut]
        at = cut
    yield text[at:]


def document(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their weights, which add up to one."""
    total, n = np.zeros(BUCKETS), 0
    for part in slices(text):
        items = Items([part])
        total += np.bincount(items.buckets, items.shares[items.item], BUCKETS)
        n += int(items.n_items[0])
    places = np.flatnonzero(total)
    return places, (total[places] / max(1, n)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Log-odds of class 1 for each bucket, and of the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        parts = [(i, part) for i, text in enumerate(texts) for part in slices(text)]
        at = 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end][1]) <= BATCH_BYTES):
                size += len(parts[end][1])
                end += 1
            items, owners = Items([part for _, part in parts[at:end]]), [i for i, _ in parts[at:end]]
            sums = np.bincount(items.text[items.item], self.weights[items.buckets] * items.shares[items.item], end - at)
            np.add.at(total, owners, sums)
            np.add.at(n, owners, items.n_items)
            at = end
        odds = self.bias + total / np.maximum(1, n)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, weights, label), one document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    if not examples:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    step, steps = 0, epochs * len(examples)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            index, weight, label = examples[i]
            hidden = weight @ vectors[index]
            odds = hidden @ output + bias
            error = np.exp(odds - odds.max())
            error /= error.sum()
            error[label] -= 1
            error *= rate * (1 - step / steps)
            back = output @ error
            output -= np.outer(hidden, error)
            bias -= 0.1 * error
            vectors[index] -= weight[:, None] * back
            step += 1
    return Model(vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Documents no label of which is learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Model:
    """Train on up to ``limit`` labelled documents that are not held out."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.min("quality").cast("int").alias("label"))
    chosen = F.broadcast(marked.orderBy(F.xxhash64("labelled"), "labelled").limit(limit))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(chosen, texts.doc_id == chosen.labelled).select("doc_id", "text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document(t.as_py().encode()) for t in batch.column(1)]
            arrays = [
                batch.column(0),
                pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                pa.array([w for _, w in found], pa.list_(pa.float32())),
                batch.column(2),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "buckets", "weights", "label"])

    counted = texts.mapInArrow(count, "doc_id long, buckets array<int>, weights array<float>, label int").toArrow()
    rows = zip(*(counted.column(c) for c in ("doc_id", "buckets", "weights", "label")))
    examples = [(i.as_py(), b.values.to_numpy(), w.values.to_numpy(), label.as_py()) for i, b, w, label in rows]
    examples.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
    return train([x[1:] for x in examples])


def score_column(model: Model, text: str = "text") -> Column:
    shipped = model

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shipped.scores([t.encode() for t in texts]), dtype=float)

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``: 1 from ``ACCEPTED`` on."""
    model = fit(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(model).alias("score"))
    flag = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", flag.alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without those the classifier rejects."""
    return docs.where(score_column(fit(docs, labels)) >= ACCEPTED)
