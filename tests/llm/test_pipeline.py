"""The pipeline's stages, each on its own input, against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from visitlens.llm.common import Scratch

COMMON = {"aa": ["that", "the", "and", "of", "which", "with"], "bb": ["und", "der", "ein", "ich", "nicht", "auch"]}
ITEM = "seven quiet otters carried the wooden ladder across a frozen river"


def made():
    rng = random.Random(7)
    rows = []
    for i in range(120):
        lang = ["aa", "bb"][i % 2]
        text = " ".join(rng.choice(COMMON[lang]) + rng.choice(["", "ly", "en", "ish"]) for _ in range(60))
        rows.append((i, text, lang, ["s1", "s2", None][i % 3]))
    near = rows[4][1].split()
    rows += [(200, rows[4][1], "aa", "s1"), (201, " ".join([*near[:-1], "odd"]), "aa", "s2"),
             (202, rows[9][1] + " " + ITEM.upper() + " " + rows[11][1], "bb", "s1"),
             (203, None, "aa", "s1"), (204, "", None, "s2"), (205, "12 !?", "aa", "s1"),
             (206, "жщэ юяъ ыьф хцч" * 20, None, "s2")]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (rows in, rows out) of every stage."""
    sf_dir = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(made(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(
        f"{sf_dir}/benchmark.parquet")
    docs, scratch, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "test"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.save(stage(spark, docs, sf_dir), name)
        if name != "token_frames":
            assert after.columns == docs.columns
        out[name] = (docs.collect(), after.collect())
        docs = after
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(whole) == sorted(out["token_frames"][1])
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_language_stage_drops_what_is_no_language(stages):
    before, after = stages["language_id"]
    assert set(ids(before)) - set(ids(after)) == {203, 204, 205, 206}


def test_near_stage_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    sets = {}
    for r in before:
        w = r.text.lower().split()
        sets[r.doc_id] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    label = {i: i for i in sets}
    for _ in range(4):
        for i, a in sets.items():
            for j, b in sets.items():
                if 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    assert label[200] == label[201] == 4
    assert ids(after) == sorted(i for i in label if label[i] == i)


def test_contamination_stage_drops_holders_of_a_window(stages):
    def windows(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        return {tuple(w[k:k + 10]) for k in range(len(w) - 9)}

    before, after = stages["decontamination"]
    assert ids(after) == sorted(r.doc_id for r in before if not windows(r.text) & windows(ITEM))
    assert 202 in ids(before) and 202 not in ids(after)


def test_mixing_stage_gives_each_source_its_words(stages):
    before, after = stages["mixing"]
    own, got = collections.Counter(), collections.Counter()
    for rows, words in ((before, own), (after, got)):
        for r in rows:
            words[r.source] += len(r.text.split())
    weights = {"s1": 1, "s2": 2, None: 3}
    total = sum(own.values())
    target, free = {}, set(own)
    while True:  # cap and reshare
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * own[s]}
        if not over:
            break
        target |= {s: 3 * own[s] for s in over}
        free -= over
    target |= share
    assert all(abs(got[s] - target[s]) <= 0.5 for s in own)
    texts = {r.doc_id: r.text for r in before}
    cut = [r for r in after if r.text != texts[r.doc_id]]
    assert all(texts[r.doc_id].split()[:len(r.text.split())] == r.text.split() for r in after)
    assert len(cut) <= len(own) and all(r.n_chars == len(r.text) for r in after)
    assert max(collections.Counter(r.doc_id for r in after).values()) <= 3


def test_token_stage_lists_what_it_wrote(stages):
    before, after = stages["token_frames"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def digest(r):
        row = np.array([*tok.encode(r.text, add_special_tokens=False).ids, 2], dtype="<u4")
        return r.doc_id, len(row), zlib.crc32(row.tobytes())

    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == sorted(map(digest, before))
    start = 0
    for r in sorted(after, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    assert ids(sorted(after, key=lambda r: r.start)) == [r.doc_id for r in sorted(after, key=lambda r: r.start)]
