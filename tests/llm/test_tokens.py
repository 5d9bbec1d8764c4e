"""Ids by pieces against the library, called as the contract calls it, on whole texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rowgate.llm import tokens
from rowgate.llm.tokens import WordIds

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PARTS = [
    *[" ", " ", "\n", "  ", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "᠎", " ", " ", "​", " ", " ", " ", " ", "　", "﻿"],
    *["a", "B", "é", "é", "ß", "Σ", "İstanbul", "ǅ", "word", "kahve", "here", "漢字", "ไทย", "🙂", "́", "”", "—", "ﬁ"],
    *["é.", "×.", "÷,", "ÿ!", "9:", "́.", ")", "?'s", ".", ",", "!", "'s", "'LL", "1", "23", "..", "a$$", "\0", "<|endoftext|>", "<|startoftext|>", "<|", "|>"],
]


def of_library(path, texts, spell=False):
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = spell
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def of_pieces(encoder, texts):
    return [ids.tolist() for ids in encoder.encode(pa.array(texts, pa.string()))]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_texts_whose_words_have_unequal_parts(path):
    texts = ["start\nword\nİstanbul", "the word was kahve İstanbul here", "the kahve was here", "a <|endoftext|> b", "", " ", "\n\n"]
    encoder = WordIds(path)
    for _ in range(2):
        assert of_pieces(encoder, texts) == of_library(path, texts)
        assert of_pieces(encoder, texts[::-1]) == of_library(path, texts[::-1])
    assert of_pieces(WordIds(path, spell_special=True), texts) == of_library(path, texts, spell=True)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_random_texts_in_batches_of_any_size(path):
    """100,000 texts, met one, few or many at a time, so that few or many pieces are new."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 20))) for _ in range(50_000)]
    expected = of_library(path, texts)
    order = rng.permutation(len(texts))
    encoder, at = WordIds(path), 0
    while at < len(texts):
        some = order[at : at + int(rng.choice([1, 2, 3, 5, 50, 2000]))]
        assert of_pieces(encoder, [texts[i] for i in some]) == [expected[i] for i in some]
        at += len(some)
    assert of_pieces(WordIds(path), texts) == expected


def test_kept_pieces_are_bounded_and_long_texts_whole(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 5_000)
    monkeypatch.setattr(tokens, "GATHERED", 300)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 200)) for _ in range(60)] + ["x" * 5000, None, "y " * 3000]
    encoder = WordIds(BYTE)
    assert of_pieces(encoder, texts) == of_library(BYTE, [t or "" for t in texts])
    assert len(encoder._kept.sizes) < 500
    sliced = pa.array(["skip", *texts, "skip"], pa.string()).slice(1, len(texts))
    assert [i.tolist() for i in encoder.encode(sliced)] == of_library(BYTE, [t or "" for t in texts])
