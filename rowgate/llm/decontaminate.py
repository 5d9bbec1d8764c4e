"""Benchmark decontamination by pigeonhole edit matching over words.

Texts are compared as sequences of lower-case words (runs of letters, digits and underscores; in
scripts that set no blanks each character is a word). An item of n words may differ from a passage by
one word in five, so one under five words must stand there unchanged: with k errors allowed it is cut
into k + 1 pieces, one of which a match holds unchanged. All pieces are sought at once by an automaton,
and the words around a hit are verified with Myers' bit-parallel edit distance. Items are a stated
query set; they are shipped to the tasks in blocks of at most ``BLOCK_BYTES`` of text.

Null texts have no words, nor are items without words sought; a caller who takes very short items for
chance may raise ``min_words``. Repeated items are
reported one by one, repeated rows as well; without items or rows there are no matches.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import id_and_text

BLOCK_BYTES, MIN_WORDS, ERROR_SHARE = 4_000_000, 1, 5
LEAKS = "doc_id long, item_id long, errors int, allowed int, end_word long"
_OTHER = re.compile(r"\W+")
# Letters of Thai, Lao, Tibetan, Burmese, Khmer, kana and Han, which are written without blanks.
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def normal(text: str) -> str:
    """Words in lower case, a blank before and after each."""
    if _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", text)
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def pieces(n: int, k: int) -> list[tuple[int, int]]:
    """``n`` words cut into ``k + 1`` pieces of nearly equal length."""
    bounds = [i * n // (k + 1) for i in range(k + 2)]
    return list(zip(bounds, bounds[1:]))


class Pattern:
    """An item, ready for Myers' search: a bit mask of places for every word."""

    def __init__(self, item_id: int, words: list[str]):
        self.item_id, self.n, self.allowed = item_id, len(words), len(words) // ERROR_SHARE
        self._masks: dict[str, int] = defaultdict(int)
        for place, word in enumerate(words):
            self._masks[word] |= 1 << place

    def search(self, words: list[str]) -> tuple[int, int]:
        """The least edit distance of the item to a run of ``words``, and where that run ends."""
        every, top = (1 << self.n) - 1, 1 << (self.n - 1)
        plus, minus, score, best = every, 0, self.n, (self.n, 0)
        masks = self._masks
        for at, word in enumerate(words, 1):
            equal = masks.get(word, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (every & ~(horizontal | plus))
            down = plus & horizontal
            score += bool(up & top) - bool(down & top)
            if score < best[0]:
                best = (score, at)
            up, down = (up << 1) & every, (down << 1) & every
            plus = down | (every & ~(vertical | up))
            minus = up & vertical
        return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS):
        hits = defaultdict(list)
        for item_id, text in items:
            words = normal(text).split()
            if len(words) >= min_words:
                pattern = Pattern(item_id, words)
                for a, b in pieces(pattern.n, pattern.allowed):
                    hits[" " + " ".join(words[a:b]) + " "].append((pattern, a))
        self._automaton = ahocorasick.Automaton()
        for piece, found in hits.items():
            self._automaton.add_word(piece, (len(piece), found))
        if hits:
            self._automaton.make_automaton()
        self._empty = not hits

    def matches(self, text: str) -> list[tuple[Pattern, int, int]]:
        """The items found, each with its least errors and the word behind that match."""
        found: dict[int, tuple[Pattern, int, int]] = {}
        if self._empty:
            return []
        line = normal(text)
        words, seen, at, place = None, set(), 0, 0
        for end, (length, patterns) in self._automaton.iter(line):
            if words is None:
                words = line.split()
            start = end - length + 1
            place += line.count(" ", at, start)  # words before the hit; hits come in order of their ends
            if start < at:
                place -= line.count(" ", start, at)
            at = start
            for pattern, offset in patterns:
                aligned = place - offset  # may lie before the text; windows of different alignments end apart
                if (id(pattern), aligned) in seen:
                    continue
                seen.add((id(pattern), aligned))
                first = max(0, aligned - pattern.allowed)
                errors, stop = pattern.search(words[first : aligned + pattern.n + pattern.allowed])
                old = found.get(id(pattern))
                if errors <= pattern.allowed and (old is None or errors < old[1]):
                    found[id(pattern)] = (pattern, errors, first + stop)
        return list(found.values())


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, a bounded number of bytes at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else items
        yield [(r.item_id, r.text) for r in some.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each document and item it holds: ``errors`` of the best match, errors ``allowed``,
    and the word behind that match (``end_word``)."""
    texts, found = id_and_text(docs), None
    for items in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, min_words)
            for batch in batches:
                rows = [
                    (doc_id, pattern.item_id, errors, pattern.allowed, end)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for pattern, errors, end in matcher.matches(text.as_py())
                ]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "errors", "allowed", "end_word"]
                )

        part = texts.mapInArrow(run, LEAKS)
        found = part if found is None else found.union(part)
    return found


def _holds_item(items: list[tuple[int, str]], min_words: int):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items, min_words)
        for texts in batches:
            yield pd.Series([bool(matcher.matches(t)) for t in texts], dtype=bool)

    return leaks


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs``, all columns, without the documents that hold an item. Nothing is shuffled."""
    for items in _blocks(benchmark):
        docs = docs.where(~_holds_item(items, min_words)(F.coalesce("text", F.lit(""))))
    return docs
