"""Registered queries without SQL, on the whole smallest tables, against plain Python."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from visitlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _documents():
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"] or "", r["text"] is None) for r in rows)


def test_op2_sizes_hashes_and_slots(spark):
    out = {r.doc_id: r for r in QUERIES["op2_hilbert_sharding"](spark, SF).collect()}
    docs = _documents()
    assert sorted(out) == [d for d, _, _ in docs]
    for doc_id, text, _ in docs:
        data = text.encode()
        assert (out[doc_id]["size"], out[doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))
    shards = {}
    for r in out.values():
        assert r.law == "rows" and r.grown_shard is None
        shards.setdefault(r.shard, []).append(r.slot)
    assert sorted(shards) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    counts = [len(s) for s in shards.values()]
    assert max(counts) - min(counts) <= 1


def test_op4_counts_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit)
           for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    want = {}
    for doc_id, text, _ in _documents():
        n = len(library.encode(text, add_special_tokens=False).ids)
        want[doc_id] = (len(text.encode()), n, n > 2048)
    assert got == want


def test_op9_ids_equal_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32)
                 for r in QUERIES["op9_token_frames"](spark, SF).collect())
    want, start = [], 0
    for doc_id, text, _ in _documents():
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == want
