"""Base findings of op3 and ids of op9 on odd texts, against brute force."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from visitlens.llm import secret_linking, token_frames

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base_spans(text):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))


def random_text(rng):
    parts = ["password=abc", "AKIA12", "token: 'abcdef1'", "AKIA" + "Z9" * 9, "deadbeef" * 3,
             "deadbeef", "API_key = hunter22", "\U0001f511", "ü", "\n\n", "\n", " ", "plain", "x" * 40,
             "secret", "=", "user=bob", "https://h.example/x", "aB3" * 12, "apikey:", "\r\n \n", "\x00"]
    return "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 14)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    fixed = ["password=abc", "AKIA12", "plain", "see AKIA12 and key " + "a" * 30, None, "", " "]
    texts = fixed + [random_text(rng) for _ in range(400)]
    # ids repeat and are missing
    return [(None if i % 50 == 49 else i // 2 if i % 20 == 1 else i, t) for i, t in enumerate(texts)]


def test_base_secrets_equal_brute_force_and_no_row_is_lost(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(secret_linking, "documents", lambda spark, sf_dir: docs)
    got, want = [], []
    for r in secret_linking.op3(spark, "").collect():
        got.append((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256))
    for i, t in rows:
        spans = base_spans(t or "")
        n = [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((i or -1, *n, hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(got) == sorted(want)


def test_frames_hold_the_library_s_ids_for_odd_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), token_frames.Encoder(path)
    rng = random.Random(4)
    bits = ["a", "b", " ", "  ", "\n", "\x00", "\x01", "\x7f", "\xff", "\x85", "\xa0", "\t", "\x1c", "'s",
            "Ā", "\U00010348", "9", "<|endoftext|>", "!", ",", "$$", ".", "　"]
    texts = [" \x00b", "a \x00b", "\x00", " \x00", "\x00 \x00\x00 b"] + [
        "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    import numpy as np
    for _ in range(2):      # the second time from what the encoder remembers
        for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<u4").tolist() == want, repr(text)


def test_frames_are_read_back_by_a_task_per_file(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, (t or "") * 50) for i, t in enumerate(t for _, t in rows)],
                                 "doc_id long, text string").repartition(4)
    uri = token_frames.Scratch(spark, "frames-test").path
    with_parts = token_frames.write_token_frames(docs.repartition(8), uri, path).collect()
    files = spark.createDataFrame(with_parts, "part int, file string, n_docs long, n_ids long")
    out = token_frames.read_token_frames(files, uri)
    assert out.rdd.getNumPartitions() == len(with_parts)
    assert out.count() == len(rows)
