"""Personal data against the contract's patterns, and the kinds the method adds."""

import hashlib
import random
import re

import pytest

from visitlens.llm import personal_data as pd_

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])     # noqa: E731
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text)
              if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return found


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


PARTS = ["a@b.c", "@", ".", "-", "x_%+y", "b-c.d", "\U0001f600", "ü", " ", "  ", "\n", "1", "23", "255", "256",
         "0010", "1.2.3.4", "10.0.0.1", "+", "+4", "+49 (0) 30.12-34", "()", "4111 1111 1111 1111",
         "4111-1111-1111-1111", "4012888888881881", "0000 0000 0000 0000", "5", "://", "http", "u:p@h.de/",
         "iban", "IBAN DE89 3704 0044 0532 0130 00", "account: 12345678", "Acct", "no. 99887766", "/", "\x00"]


def random_text(rng):
    if rng.random() < .5:
        return "".join(rng.choice("0123459 -.+@a(") for _ in range(rng.randint(0, 40)))
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    for _ in range(30_000):
        text = random_text(rng)
        spans = [(pd_.KINDS[k], a, b) for k, a, b in pd_.find_spans(text)]
        assert [s for s in spans if s[0] in pd_.KINDS[:4]] == base_spans(text), repr(text)
        for kind in pd_.KINDS:      # spans of a kind do not overlap
            own = [s for s in spans if s[0] == kind]
            assert all(p[2] <= q[1] for p, q in zip(own, own[1:])), repr(text)


def found(text):
    return [(pd_.KINDS[k], text[a:b]) for k, a, b in pd_.find_spans(text)]


@pytest.mark.parametrize("text,spans", [
    ("see https://bob:pw@host.example/x", [("email", "pw@host.example"), ("login", "https://bob:pw@host.example")]),
    ("https://host.example/a@b", []),
    ("IBAN: DE89 3704 0044 0532 0130 00.", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("iban GB82WEST12345698765432", [("iban", "GB82WEST12345698765432")]),
    ("iban GB83WEST12345698765432", []),
    ("Account number: 0012-3456", [("account", "0012-3456")]),
    ("accounts 123456, account 123", []),
    ("konto 12345678 and subaccount 12345678", [("account", "12345678")]),
])
def test_added_kinds(text, spans):
    assert found(text) == spans


def test_long_runs_take_linear_time():
    import time
    start = time.time()
    for text in ("a" * 300_000 + "@", "1." * 200_000, "1 " * 200_000, "+1" * 200_000, "@a" * 200_000,
                 "a://" * 100_000, "iban" * 100_000, "a.b@" * 100_000):
        pd_.find_spans(text)
    assert time.time() - start < 20


def test_query(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", " "] + [random_text(rng) for _ in range(300)] + ["x " * 20_000 + "a@b.c"]
    rows = [(None if i % 40 == 39 else i // 2 if i % 20 == 1 else i, t, "k", 1) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = sorted(str((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
                 for r in pd_.op13(spark, str(tmp_path)).collect())
    want = []
    for i, t, *_ in rows:
        spans = base_spans(t or "")
        n = [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        want.append(str((i, *n, digest(spans))))
    assert got == sorted(want)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert pd_.op13(spark, f"{tmp_path}/none").count() == 0


def test_masked_texts(spark):
    docs = spark.createDataFrame([(1, "ü a@b.c, +49 30 123456."), (2, None), (3, "clean")],
                                 "doc_id long, text string")
    assert {r.doc_id: r.text for r in pd_.masked(docs).collect()} == {
        1: "ü [email], [phone].", 2: None, 3: "clean"}
