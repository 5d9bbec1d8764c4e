"""The near-copy stage against all pairs compared one by one."""

import corpus_pipeline
from test_operators import components, odd

from rowgate.llm import near_copies, simhash


def brute_shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({b" ".join(words)} if words else set())


def alike(a, b):
    return a == b or 9 * len(a & b) >= 4 * (len(a) + len(b)) > 0


def test_stage_links_all_pairs_at_least_four_fifths_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = components({r.doc_id: brute_shingles(r.text) for r in docs.collect()}, alike)
    found = {r.doc_id: r.component_id for r in near_copies.groups(docs).collect()}
    assert found == expected
    kept = corpus_pipeline.drop_near_copies(spark, docs, None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in expected.items() if i == c)


def test_chains_and_odd_input(spark):
    words = [f"w{i}" for i in range(400)]
    chain = [(10 + i, " ".join([*words[i * 15 : i * 15 + 200], "END"])) for i in range(13)]
    df = odd(spark, [(1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "A  b"), (None, "x"), *chain])
    expected = components({i: brute_shingles(t) for i, t in chain}, alike)
    assert len(set(expected.values())) == 1 and not alike(brute_shingles(chain[0][1]), brute_shingles(chain[-1][1]))
    kept = near_copies.one_per_group(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 10]
    assert near_copies.one_per_group(df.limit(0)).count() == 0


def test_simhash_names_candidates_and_the_likeness_decides(spark, monkeypatch):
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(near_copies, "_hub_links", lambda keyed: none)
    monkeypatch.setattr(near_copies, "_partners", lambda index: none)
    words, phrase = [f"w{i}" for i in range(900)], [f"p{i}" for i in range(40)]
    texts = {1: " ".join(words), 2: " ".join([*words, "end"]), 5: "a text of its own kind"}
    texts |= {i: " ".join(phrase * 20 + [f"odd{i}x{j}" for j in range(30)]) for i in (3, 4)}
    for a, b, near in ((1, 2, True), (3, 4, False)):
        assert (simhash.fingerprint(texts[a]) ^ simhash.fingerprint(texts[b])).bit_count() <= simhash.BITS
        assert alike(brute_shingles(texts[a]), brute_shingles(texts[b])) == near
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, None).collect()) == [1, 3, 4, 5]
