"""The language model against Kneser-Ney by hand, and beyond the limits it once had."""

import random
import zlib

import numpy as np
import pytest

from visitlens.llm import language_id


def model_by_hand(texts):
    """lang -> {gram: count} by order; a text is led by three spaces and ends with one."""
    levels = {}
    for lang, own in texts.items():
        top = {}
        for t in own:
            t = "   " + t + " "
            for k in range(3, len(t)):
                top[t[k - 3:k + 1]] = top.get(t[k - 3:k + 1], 0) + 1
        levels[lang] = {4: top}
        for order in (3, 2, 1):
            low = levels[lang][order] = {}
            for g in levels[lang][order + 1]:
                low[g[1:]] = low.get(g[1:], 0) + 1
    floor = 1 / (len({c for x in levels.values() for c in x[1]}) + 1)

    def p(lang, gram):
        if not gram:
            return floor
        own = levels[lang][len(gram)]
        n = list(own.values())
        d = min(0.9, max(0.1, n.count(1) / max(1, n.count(1) + 2 * n.count(2))))
        seen = [v for g, v in own.items() if g[:-1] == gram[:-1]]
        if not seen:
            return p(lang, gram[1:])
        return max(own.get(gram, 0) - d, 0) / sum(seen) + d * len(seen) / sum(seen) * p(lang, gram[1:])
    return p


@pytest.mark.parametrize("rows", [5, 1_000_000])
def test_entropies_are_those_of_kneser_ney(spark, monkeypatch, rows):
    monkeypatch.setattr(language_id, "RANGE_ROWS", rows)   # many files, or one
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 2)
    texts = {"aa": ["the cat and the hat", "that is this"], "bb": ["der hut und das tier"],
             "cc": ["한국어 말 한국", "言語 の 言葉 한국"]}
    languages = sorted(texts)
    rows = [(t, x) for x, own in texts.items() for t in own]
    counts = spark.createDataFrame(rows, "text string, lang string").mapInArrow(
        language_id._counter(languages), "lang int, gram long, n long").groupBy("lang", "gram").sum("n")
    model = language_id.fit(languages, counts.withColumnRenamed("sum(n)", "n"))
    asked = ["the hut", "한국 hat", "xyz 語", "und das"]
    got, chars, _ = language_id.entropies(model, asked)
    p = model_by_hand(texts)
    for i, t in enumerate(asked):
        padded = "   " + t + " "
        for j, x in enumerate(languages):
            want = [-np.log(p(x, padded[k - 3:k + 1])) for k in range(3, len(padded))]
            assert chars[i] == len(want) and got[i, j] == pytest.approx(np.mean(want), rel=1e-5)


def test_every_language_is_learned(spark):
    """More languages than 200, some with rows in one fold only, some with one row."""
    rng = random.Random(6)
    rows, seen = [], 0
    for k in range(230):
        letters = [chr(0x4E00 + 30 * k + j) for j in range(30)]
        for _ in range(1 if k % 20 == 3 else 4):
            while zlib.crc32(str(seen).encode()) % 3 == 1 or (
                    k % 20 == 5 and zlib.crc32(str(seen).encode()) % 3 == 0):
                seen += 1   # not held out, and for some languages not counted
            rows.append((seen, "".join(rng.choice(letters) for _ in range(80)), f"l{k:03}"))
            seen += 1
    out = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {i: lang for i, _, lang in rows}


def test_a_language_of_many_characters_does_not_loosen_the_others(spark):
    rng = random.Random(8)
    words = ["that", "the", "and", "of", "which", "with", "from", "have", "were", "their"]
    vowels, consonants = "aeiou", "bcdfghjklmnpqrstvwxyz"
    words += ["".join(rng.choice(consonants) + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
              for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "aa") for i in range(300)]
    rows += [(300 + i, "".join(chr(rng.randrange(0x4E00, 0x8E00)) for _ in range(400)), "hh")
             for i in range(300)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    odd = [(1000 + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
                               for _ in range(80)), None) for i in range(20)]
    mixed = [(2000 + i, t + " 漢字", None) for i, t, _ in rows[:20]]
    docs = spark.createDataFrame(rows + odd + mixed, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert all(out[i].rejected for i, _, _ in odd)
    assert not any(out[i].rejected for i, _, _ in rows + mixed)
    assert all(out[i].lang_pred == lang for i, _, lang in rows)


def test_letters_beyond_16_bits_are_told_apart(spark):
    """Two languages of one script, and two of another, all beyond U+FFFF."""
    rng = random.Random(9)
    scripts = {"g": [chr(c) for c in range(0x10330, 0x10349) if chr(c).isalpha()],
               "b": [chr(c) for c in range(0x10000, 0x1000C) if chr(c).isalpha()]}
    words = {s + n: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(40)]
             for s, letters in scripts.items() for n in "12"}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(30)), x)
            for i in range(400) for x in [sorted(words)[i % 4]]]
    out = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    held = [r for r in out if r.held_out]
    want = {i: x for i, _, x in rows}
    assert len(held) > 80 and sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) > 0.95
    table = language_id._letters()
    own = table[[c for c in range(0x10000, 0x10900) if chr(c).isalpha()]]
    assert len(set(own.tolist())) == len(own) and not any(chr(c).isalpha() for c in own.tolist())
