"""The pipeline's stages with extra columns of the stages' own names, and on empty tables."""

import random

import corpus_pipeline
from visitlens.llm.common import Scratch

NAMES = ["taken", "_size", "_row", "row", "doc", "cut", "_cut", "size", "_letters", "_lang_pred",
         "_rejected", "_h", "c0", "target", "component_id", "part"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"`{c}` string" for c in NAMES))


def table(spark, tmp_path, rows):
    spark.createDataFrame([(1, "seven quiet otters carried the wooden ladder across a frozen river")],
                          "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return Scratch(spark, "columns-test").save(docs, "docs")


def test_extra_columns_of_any_name_come_back_unchanged(spark, tmp_path):
    rng = random.Random(4)
    words = {"aa": ["that", "the", "and", "of"], "bb": ["und", "der", "ein", "ich"]}
    rows = [(i, " ".join(rng.choice(words[x]) + rng.choice(words[x]) for _ in range(40)), x, "s1", 200,
             *[f"{c} {i}" for c in NAMES]) for i in range(120) for x in [["aa", "bb"][i % 2]]]
    docs = table(spark, tmp_path, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = Scratch(spark, f"columns-{name}").save(stage(spark, docs, str(tmp_path)), "out")
        assert out.dtypes == docs.dtypes, name
        assert out.count() >= 100, name
        for r in out.collect():
            assert all(r[c] == f"{c} {r.doc_id}" for c in NAMES), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == docs.count()


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        if name != "token_frames":
            assert out.columns == docs.columns, name


def test_last_stage_writes_rows_that_repeat_or_lack_an_id(spark, tmp_path):
    rows = [(i, t, "aa", "s", 1, *NAMES) for i, t in
            [(None, "one"), (None, "two two"), (5, "same"), (5, "same"), (5, None), (7, "")]]
    out = corpus_pipeline.write_token_ids(spark, table(spark, tmp_path, rows), str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    at = 0
    for r in sorted(out, key=lambda r: r.start):       # in order, without a gap
        assert r.start == at
        at += r.n_tokens
