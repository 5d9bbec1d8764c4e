"""Texts without blanks and very long texts are read to their end."""

import numpy as np

from rowgate.llm import decontaminate, quality


def test_item_behind_a_lead_of_its_own_end():
    words = [f"w{i}" for i in range(30)]
    matcher = decontaminate.Matcher([(1, " ".join(words))])
    lead = words[-5:]
    found = matcher.matches(" ".join([*lead, *words, "other", "words"]))
    assert [(p.item_id, errors, end) for p, errors, end in found] == [(1, 0, 35)]


def brute_errors(item, words):
    """The least edit distance of an item to any run of words."""
    row = [0] * (len(words) + 1)
    for i, wanted in enumerate(item, 1):
        last, row[0] = row[:], i
        for j, word in enumerate(words, 1):
            row[j] = min(last[j - 1] + (wanted != word), last[j] + 1, row[j - 1] + 1)
    return min(row)


def test_short_items_and_scripts_without_blanks():
    rng = np.random.default_rng(4)
    han, kana = "漢字文章機械学習評価", "あいうえおカキクケコ"
    made = lambda letters, n: "".join(rng.choice(list(letters), n))
    items = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], i % 4 + 1))) for i in range(30)]
    items += [(100 + i, made(han + kana, int(rng.integers(1, 40)))) for i in range(30)] + [(200, "ภาษาไทยไม่มีช่องว่าง"), (201, "?!"), (202, "")]
    matcher = decontaminate.Matcher(items)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x"], 8)) for _ in range(60)]
    texts += [made(han + kana, 30) + items[30 + i][1] + made(han, 9) for i in range(30)]
    texts += [made(kana, 5) + items[50][1][:-2] + "。X" + items[50][1][-1:], "ก่อน ภาษาไทยไม่มีช่องว่าง", "", "!?"]
    for text in texts:
        words = decontaminate.normal(text).split()
        expected = {}
        for item_id, item in items:
            wanted = decontaminate.normal(item).split()
            errors = brute_errors(wanted, words)
            if wanted and errors <= len(wanted) // decontaminate.ERROR_SHARE:
                expected[item_id] = errors
        assert {p.item_id: errors for p, errors, _ in matcher.matches(text)} == expected


def test_long_words_are_scored_to_their_end():
    """Runs of 364 characters that differ behind the first 64 only."""
    rng = np.random.default_rng(1)

    def made(letters):
        return ("a" * 64 + "".join(rng.choice(list(letters), 300))).encode()

    examples = [(*quality.document(made("漢字文章" if i % 2 else "xyzqj")), i % 2) for i in range(200)]
    model = quality.train(examples)
    good, bad = ([made(letters) for _ in range(50)] for letters in ("漢字文章", "xyzqj"))
    assert model.scores(good).min() > 0.7 > 0.5 > model.scores(bad).max()


def test_features_are_those_counted_one_by_one():
    """Words, n-grams of bytes with a blank around each word, and pairs, without arrays."""
    text = b"ab  c\nab c dd\t"
    words = text.split()
    per_word = []
    for word in words:
        padded = b" " + word + b" "
        grams = [padded[i : i + n] for n in quality.GRAMS for i in range(len(padded) - n + 1)]
        per_word.append(1 + sum(1 for g in grams if b" " not in g[1:-1] and g.strip()))
    items = quality.Items([b"", text, b" \n", b"x"])
    assert items.n_items.tolist() == [0, len(words) + len(words) - 1, 0, 1]
    assert np.bincount(items.item)[: len(words)].tolist() == per_word
    one, again = quality.Items([text]), quality.Items([b"x y z", text])
    mine = again.text[again.item] == 1
    assert sorted(one.buckets.tolist()) == sorted(again.buckets[mine].tolist())
    places, weights = quality.document(text)
    assert abs(weights.sum() - 1) < 1e-6 and len(quality.document(b"")[0]) == 0


def test_order_of_words_matters_and_slices_lose_no_word(monkeypatch):
    assert quality.document(b"a b c")[0].tolist() != quality.document(b"c b a")[0].tolist()
    text = b" ".join(f"w{i % 50}".encode() for i in range(4000)) + b"x" * 3000
    whole = quality.Items([text])
    monkeypatch.setattr(quality, "BATCH_BYTES", 1000)
    parts = [quality.Items([p]) for p in quality.slices(text)]
    assert b"".join(quality.slices(text)) == text and all(len(p) <= 1000 for p in quality.slices(text))
    words = len(text.split())
    assert whole.n_items[0] == 2 * words - 1
    assert sum(int(p.n_items[0]) for p in parts) >= 2 * words - 1 - len(parts)
    model = quality.Model(np.random.default_rng(0).normal(0, 1, quality.BUCKETS).astype(np.float32), 0.1)
    assert np.allclose(model.scores([b"q", text, b"w1 w2"])[[0, 2]], model.scores([b"q", b"w1 w2"]))
