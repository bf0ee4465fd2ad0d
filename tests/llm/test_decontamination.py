"""Decontamination against brute force: words, windows, blocks and full filters."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import decontamination

BITS = ["a", "B", "c", "d9", "é", "Éa", "x-y", "  ", "\n", ".", "ﬂ", "\x00", "it's"]


def brute(text, items, window):
    own, hit, ids = decontamination.words(text), set(), set()
    for item_id, item in items:
        words = decontamination.words(item)
        length = min(window, len(words))
        for k in range(len(words) - length + 1 if length else 0):
            for at in range(len(own) - length + 1):
                if own[at:at + length] == words[k:k + length]:
                    hit |= set(range(at, at + length))
                    ids |= {item_id} - {None}
    return len(own), len(hit), sorted(ids)


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(BITS) for _ in range(500)) + " " + "z" * 300 + "  "
    low, starts, ends, whole = decontamination.hashed(text.encode())
    assert [low[s:e] for s, e in zip(starts, ends)] == decontamination.words(text)
    same = {}
    for word, h in zip(decontamination.words(text), whole.tolist()):
        assert same.setdefault(word, h) == h
    assert len(set(same.values())) == len(same)
    monkeypatch.setattr(decontamination, "CHUNK_BYTES", 7)
    for a, b in zip((starts, ends, whole), decontamination.hashed(text.encode())[1:]):
        assert np.array_equal(a, b)


@pytest.mark.parametrize("most_bits, block_words, few", [(27, 1 << 18, 1_000_000), (4, 5, -1)])
def test_random_texts_equal_brute_force(spark, monkeypatch, most_bits, block_words, few):
    """Also with filters that let nearly everything through, and without broadcasts."""
    monkeypatch.setattr(decontamination, "MOST_BITS", most_bits)
    monkeypatch.setattr(decontamination, "FEW_WINDOWS", few)
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))

    items = [(rng.choice([None, i, i // 2]), text(9)) for i in range(25)] + [(90, None), (91, "")]
    texts = [text(60) for _ in range(60)] + [None, "", items[0][1], " ".join([items[3][1]] * 400)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)],
                                 "doc_id long, text string, window string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    found = decontamination.find_contamination(docs, bench, window=4, block_words=block_words).select(
        "doc_id", "n_words", decontamination.hit_words(F.col("ranges")).alias("n"), "items").collect()
    want = {i: brute(t, items, 4) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_words, r.n, sorted(r["items"])) for r in found} == want
    left = decontamination.uncontaminated(docs, bench, window=4, block_words=block_words)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i, w in want.items() if not w[1]]


def test_empty_benchmark_leaves_every_document(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.uncontaminated(docs, bench).count() == 2
    assert {(r.doc_id, r.n_words, len(r.ranges)) for r in decontamination.find_contamination(
        docs, bench).collect()} == {(1, 3, 0), (None, 0, 0)}
