"""Chunk maps of the token transducer: any cutting gives the library's count."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from visitlens.llm import token_counts

BITS = ["a", "Be", "ing", "é", "é", "́", "9", "07", "'s", "'", "'ll", " ", "\n", "\xa0", "--", "<",
        "<|endoftext|>", "漢", "字", "Σ", "١", "\x00", ".", "…"]


def _texts(rng, many, most):
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, most))) for _ in range(many)]


def test_maps_compose_in_any_grouping():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, machine = Tokenizer.from_file(path), token_counts.transducer(path)
    rng = random.Random(8)
    for text in _texts(rng, 1500, 30):
        maps, at = [], 0
        while at < len(text):
            n = rng.randint(1, 6)
            maps.append(machine.chunk_map(text[at:at + n]))
            at += n
        cut = rng.randint(0, len(maps))
        whole = machine.compose([machine.compose(maps[:cut]), machine.compose(maps[cut:])])
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.total(whole) == machine.total(machine.compose(maps)) == want, repr(text)


def test_long_texts_without_white_space(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(9)
    texts = _texts(rng, 30, 60) + [
        "漢字" * 200, "QmFzZTY0/x9+" * 100, "0" * 500, None, "", "a" * 7, "b" * 8,
        "".join(rng.choice("漢字語abc") for _ in range(700))]
    docs = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, nth int")
    out = token_counts.token_counts(docs, path, chunk_chars=7, fan=3).collect()
    want = [(i // 2, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
            for i, t in enumerate(texts)]
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == sorted(want)


def test_states_inside_long_runs_are_proven():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, machine = Tokenizer.from_file(path), token_counts.transducer(path)
    rng, edge = random.Random(10), 4 * machine.longest
    kinds = ["abcdefghijklmnopqrstuvwxyzETAOIN", "etaoinshr", "漢字語的一是不了人我在有", "жизньдом", "가나다라한국",
             "ab漢й가", "ab", "a", "th"]
    found = 0
    for round_ in range(40):
        letters = kinds[round_ % len(kinds)]
        run = "".join(rng.choice(letters) for _ in range(rng.randint(6, 12) * edge))
        text = rng.choice(["", "x", "'", "9", "é", "<|endoftext|>", "漢.", "e "]) + run + rng.choice(
            ["", ".", "'s", "́", "<|endoftext|>", "é!", " e", "7"])
        maps, at = [], 0
        while at < len(text):
            n = rng.randint(2 * edge + 1, 4 * edge)
            maps.append(machine.chunk_map(text[at:at + n]))
            at += n
        found += sum(m[3] is not None for m in maps)
        cut = rng.randint(0, len(maps))
        whole = machine.compose([machine.compose(maps[:cut]), machine.compose(maps[cut:])])
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.total(whole) == machine.total(machine.compose(maps)) == want, (letters, text[:9])
    assert found > 30


def test_a_known_state_is_the_one_that_the_whole_text_leads_to():
    machine = token_counts.transducer(public_tokenizers.path("word_bpe_49k.json"))
    rng, edge = random.Random(11), 4 * machine.longest
    for letters in ("etaoinshrdlu", "漢字語的一是不了人我在有", "abcdefghijklmnopqrstuvwxyz"):
        for last in (False, True):
            before, run = ("".join(rng.choice(letters) for _ in range(n)) for n in (77, edge))
            place, state = machine._known(run, last)
            assert state == machine._path(token_counts._REST, before + run[:place], False)[0]


def test_maps_of_a_long_run_are_small():
    machine = token_counts.transducer(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(12)
    for letters in ("etaoinshrdlu", "漢字語的一是不了人我在有"):
        head, _, tail, state, inside = machine.chunk_map("".join(rng.choice(letters) for _ in range(20_000)))
        assert inside and state and len(head) + len(tail) < 8 * machine.longest
    assert machine.chunk_map("漢字，語。" * 50)[2] == "。"
