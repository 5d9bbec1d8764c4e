"""Token ids of whole texts, one library call per distinct piece of a batch instead of one per word.

Both vocabularies split a text at least between a character that is no white space and a blank or
line feed behind it, and between a letter or digit and a mark behind it, and nothing before such a
place changes what follows it. A text is therefore cut at such places, found in its bytes, and
nowhere else: white space of other kinds and letters beyond Latin-1 stay inside a piece. The pieces
of a batch are numbered by Arrow, each different one is encoded by itself, and the ids of the texts
are gathered from theirs, so the ids are those of the library whatever the batch holds.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES, PIECES_AT_ONCE, GATHERED = 16_000_000, 4_000, 500_000
# Pieces up to so many bytes are kept for the next batches, up to so many bytes of them and their ids.
KEPT_LENGTH, KEPT_BYTES = 48, 48_000_000

_SPACE, _MARK, _LETTER = (np.zeros(256, bool) for _ in range(3))
_SPACE[[32, 10]] = True
_MARK[list(b".,!?;:)")] = True  # in no special token's string
_LETTER[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def _wide_spaces(third: np.ndarray, second: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the characters that end in these bytes are white space beyond ASCII."""
    # UTF-8 of U+0085, U+00A0, U+1680, U+180E, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
    two = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
    ogham = (third == 0xE1) & (((second == 0x9A) & (last == 0x80)) | ((second == 0xA0) & (last == 0x8E)))
    general = (third == 0xE2) & (second == 0x80) & ((last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    rest = ((third == 0xE2) & (second == 0x81) & (last == 0x9F)) | ((third == 0xE3) & (second == 0x80) & (last == 0x80))
    return two | ogham | general | rest


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts, one after the other, and where each begins and the last one ends."""
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    held = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, (places - places[0]).astype(np.int64)


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts begin."""
    before, here = data[:-1], data[1:]
    begins = np.zeros(len(data) + 1, bool)
    cuts = np.flatnonzero(_SPACE[here] & (before > 32)) + 1
    beyond = cuts[data[cuts - 1] >= 0x80]
    begins[cuts] = True
    begins[beyond[_wide_spaces(data[beyond - 3], data[beyond - 2], data[beyond - 1])]] = False
    marks = np.flatnonzero(_MARK[here]) + 1
    last, second = data[marks - 1], data[marks - 2]
    latin = (second == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)  # letters from U+00C0 to U+00FF
    begins[marks[_LETTER[last] | latin]] = True
    begins[bounds] = True
    return np.flatnonzero(begins[:-1])


def _gather(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)]


class _Kept:
    """Pieces and their ids, found by hash and compared. Beyond ``KEPT_BYTES`` only those stay that
    were met again since the last time."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.strings, self.flat = pa.array([], pa.string()), np.zeros(0, np.uint32)
        self.begins, self.sizes, self._hashes = (np.zeros(0, np.int64) for _ in range(3))
        self._order, self._used = np.zeros(0, np.int64), np.zeros(0, bool)

    def find(self, pieces: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 for those that are not kept."""
        slots = np.full(len(pieces), -1, np.int64)
        if len(self._order):
            at = np.minimum(np.searchsorted(self._hashes, hashes, sorter=self._order), len(self._order) - 1)
            near = self._order[at]
            same = np.flatnonzero(self._hashes[near] == hashes)
            equal = pc.equal(self.strings.take(pa.array(near[same])), pieces.take(pa.array(same)))
            hits = same[equal.to_numpy(zero_copy_only=False)]
            slots[hits] = near[hits]
            self._used[near[hits]] = True
        return slots

    def add(self, pieces: pa.Array, hashes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.strings = pa.concat_arrays([self.strings, pieces])
        self.flat, self.sizes = np.append(self.flat, flat), np.append(self.sizes, sizes)
        self._hashes, self._used = np.append(self._hashes, hashes), np.append(self._used, np.zeros(len(sizes), bool))
        if self.strings.nbytes + self.flat.nbytes + 40 * len(self.sizes) > KEPT_BYTES:
            used, begins = np.flatnonzero(self._used), np.cumsum(self.sizes) - self.sizes
            kept = (self.strings.take(pa.array(used)), self._hashes[used], _gather(self.flat, begins[used], self.sizes[used]), self.sizes[used])
            self._clear()
            if len(used) and kept[0].nbytes + kept[2].nbytes + 40 * len(used) < KEPT_BYTES // 2:
                self.add(*kept)
            return
        self.begins = np.cumsum(self.sizes) - self.sizes
        self._order = np.argsort(self._hashes, kind="stable")


class WordIds:
    """Ids of texts. ``spell_special`` takes the strings of special tokens as ordinary text."""

    def __init__(self, path: str, spell_special: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = spell_special
        self._kept = _Kept()

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            lists = [e.ids for e in self._tokenizer.encode_batch_fast(pieces[at : at + PIECES_AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            flat.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(flat), np.concatenate(sizes)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it those of each of some different pieces begin, and how many they are."""
        kept, words = self._kept, pieces.to_pylist()
        hashes = np.fromiter(map(hash, words), np.int64, len(words))
        slots = kept.find(pieces, hashes)
        new, old = np.flatnonzero(slots < 0), np.flatnonzero(slots >= 0)
        flat, sizes = self._new([words[i] for i in new.tolist()])
        firsts = np.cumsum(sizes) - sizes
        all_begins, all_sizes, all_flat = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.append(kept.flat, flat)
        all_begins[old], all_sizes[old] = kept.begins[slots[old]], kept.sizes[slots[old]]
        all_begins[new], all_sizes[new] = firsts + len(kept.flat), sizes
        short = np.array([len(words[i].encode()) <= KEPT_LENGTH for i in new.tolist()], bool)
        kept.add(pieces.take(pa.array(new[short])), hashes[new[short]], _gather(flat, firsts[short], sizes[short]), sizes[short])
        return all_flat, all_begins, all_sizes

    def _batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        data, bounds = _layout(texts)
        starts = piece_starts(data, bounds)
        ends = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        which = pieces.indices.to_numpy(zero_copy_only=False)
        flat, begins, sizes = self._pieces(pieces.dictionary)
        first = np.searchsorted(starts, bounds)
        del pieces, starts, ends
        at = 0
        while at < len(texts):  # a part of the texts, of bounded size unless one text alone is longer
            end = max(at + 1, int(np.searchsorted(first, first[at] + GATHERED, "right")) - 1)
            mine = which[first[at] : first[end]]
            times = sizes[mine]
            places = np.append(0, np.cumsum(times))
            ids = _gather(flat, begins[mine], times)
            cuts = places[first[at : end + 1] - first[at]].tolist()
            for a, b in zip(cuts, cuts[1:]):
                yield ids[a:b]
            at = end

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, unsigned 32-bit, some texts at a time; null texts are empty."""
        texts = texts.cast(pa.string()).fill_null("")
        _, bounds = _layout(texts)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BATCH_BYTES, "right")) - 1)
            yield from self._batch(texts.slice(at, end - at))
            at = end


@lru_cache(maxsize=2)
def word_ids(path: str, spell_special: bool = False) -> WordIds:
    """One per worker process and vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path, spell_special)
