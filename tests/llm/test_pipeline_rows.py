"""The pipeline's stages on rows that repeat or lack a ``doc_id``."""

import collections
import random

import corpus_pipeline
from visitlens.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def saved(spark, rows):
    rows = [(i, t, lang, source, len(t)) for i, t, lang, source in rows]
    return Scratch(spark, "rows-test").save(spark.createDataFrame(rows, SCHEMA).repartition(3), "docs")


def test_mixing_meets_each_row_once(spark):
    rows = [(None, " ".join(f"n{i}x{k}" for k in range(5 + i)), "aa", "s1") for i in range(12)]
    rows += [(7, " ".join(f"r{i}x{k}" for k in range(4 + i)), "aa", "s1") for i in range(6)]
    rows += [(7, "same words here", "aa", None)] * 3
    rows += [(100 + i, f"other words {i} in here", "aa", "s2") for i in range(20)]
    out = corpus_pipeline.mix_sources(spark, saved(spark, rows), "").collect()
    own, got = collections.Counter(), collections.Counter()
    for _, text, _, source in rows:
        own[source] += len(text.split())
    for r in out:
        got[r.source] += len(r.text.split())
    assert sum(got.values()) == sum(own.values())
    full = {text for _, text, _, _ in rows}
    parts = [r for r in out if r.text not in full]
    assert len(parts) <= len(own)   # at most one text a source is cut
    assert all(any(t.startswith(r.text + " ") for t in full) for r in parts)
    times = collections.Counter(r.text for r in out if r.source == "s1")
    assert max(times[t] for t in full) <= 3


def test_language_and_contamination_stages_decide_by_row(spark, tmp_path):
    rng = random.Random(4)
    words = {"aa": ["that", "the", "and", "of"], "bb": ["und", "der", "ein", "ich"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(40)), x, "s1")
            for i in range(200) for x in [["aa", "bb"][i % 2]]]
    item = "seven quiet otters carried the wooden ladder across a frozen river"
    good = {i: f"the and of that {' '.join(rng.choice(words['aa']) for _ in range(20))}" for i in (None, 7)}
    rows += [(i, t, "aa", "s1") for i, t in good.items()]
    odd = "жщэ юяъ ыьф хцч" * 20
    docs = saved(spark, rows + [(None, odd, None, "s2"), (7, odd, None, "s2")])
    after = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert sorted(r.text for r in after) == sorted(t for _, t, _, _ in rows)
    assert {r.doc_id for r in after} >= {None, 7} and not any(r.text == odd for r in after)

    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = saved(spark, rows + [(None, f"x {item} y", "aa", "s1"), (7, f"z {item}", "aa", "s1")])
    after = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(r.text for r in after) == sorted(t for _, t, _, _ in rows)


def test_near_stage_keeps_one_row_of_each_group(spark):
    def text(seed):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))

    near = text(1).split()
    rows = [(None, text(1), "aa", "s1"), (None, text(1), "aa", "s2"),   # copies, all without an id
            (None, " ".join([*near[:-1], "odd"]), "aa", "s1"),          # a near copy of them
            (5, text(2), "aa", "s1"), (5, text(2), "aa", "s1"),         # a repeated row
            (5, text(3), "aa", "s1"),                                   # the same id, another text
            (9, text(4), "aa", "s1"), (None, text(4), "aa", "s1"), (3, text(4), "aa", "s2"),
            (8, " ", "aa", "s1"), (8, "", "aa", "s1"), (10, "", "aa", "s1")]
    after = corpus_pipeline.drop_near_copies(spark, saved(spark, rows), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in after if r.text.strip() and r.doc_id) == sorted(
        [(5, text(2)), (5, text(3)), (3, text(4))])
    assert len([r for r in after if r.doc_id is None]) == 1
    assert sorted(r.doc_id for r in after if not r.text.strip()) == [8, 10]
