"""Personal data by anchor expansion (operator 13).

One Aho-Corasick pass over a text finds its anchors: at-signs, plus signs before a
digit, digits that can lie in a run (a digit behind a digit, a point, a space or a
dash), ``://`` of a scheme, and cues of identifiers (``iban``, ``account``, ...).
From each anchor a small parser walks outwards over the characters its kind allows,
takes the whole run and validates it:

* ``email``: back over the local part, forward over domain labels (two at least);
* ``ip``: the run of numbers joined by single points, taken by fours, parts to 255;
* ``card``: the run of digits joined by at most one space or dash, 16 to 19 of them,
  right by Luhn's sum;
* ``phone``: forward from the plus sign to the last digit of its run, 8 to 15 digits;
* ``login``: from a scheme to the end of its authority, if that names a user;
* ``iban``: behind its cue, two letters and two check digits, right modulo 97;
* ``account``: behind its cue and at most one ``:``, ``=`` or ``#``, 6 to 18 digits.

A parser that has taken a run goes on behind it, so spans of one kind never overlap,
and work is linear in the text, whatever its length: a run is walked once for each
of the kinds that it can be. Rows are independent, so no data is shuffled.

Defined results: NULL and empty text have no spans; a row is a document of its own,
also where ``doc_id`` repeats or is NULL; places are code points, ends exclusive;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import documents, pieces

#: Base kinds, then the kinds the method adds.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "account")
BASE = 4
#: Cues in lower case, and the lengths of an account number.
CUES = {"iban": ("iban",), "account": ("account", "acct", "konto", "compte", "cuenta")}
ACCOUNT_DIGITS = (6, 18)
IBAN_CHARS = (15, 34)

_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER = re.compile("[0-9]+")
_POINTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"[ ().0-9-]*")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>]*")
_IBAN = re.compile(r"[:=#]?[ ]?([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){8,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?))?[ ]?[:=#]?[ ]?([0-9](?:[ -]?[0-9])*)", re.I)
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


@lru_cache(maxsize=1)
def _anchors():
    """The automaton; its values are (kind of anchor, characters of the anchor)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for name in ("@", "://"):
        found.add_word(name, (name, len(name)))
    for d in _DIGITS:
        found.add_word("+" + d, ("+", 2))
        for e in _DIGITS:
            found.add_word(d + "." + e, (".", 3))
            for between in ("", " ", "-"):
                found.add_word(d + between + e, ("9", 2 + len(between)))
    for kind, cues in CUES.items():
        for cue in cues:
            # texts are not lower-cased, as that can move places
            for form in (cue, cue.capitalize(), cue.upper()):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_holds(value: str) -> bool:
    value = value.replace(" ", "")
    if not IBAN_CHARS[0] <= len(value) <= IBAN_CHARS[1]:
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _run_start(text: str, at: int, low: int, allowed) -> int:
    while at > low and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, sign: int, low: int):
    start = _run_start(text, sign, low, _LOCAL_CHARS)
    domain = _DOMAIN.match(text, sign + 1) if start < sign else None
    return domain and (start, domain.end())


def _ips(text: str, start: int, end: int):
    numbers = [(m.start(), m.end()) for m in _NUMBER.finditer(text, start, end)]
    for k in range(0, len(numbers) - 3, 4):
        four = numbers[k:k + 4]
        if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b].lstrip("0") or 0) <= 255
               for a, b in four):
            yield four[0][0], four[3][1]


def _phone(text: str, plus: int):
    """End of the phone number at a plus sign: the last digit of its run, which has
    one character at least between it and the first digit."""
    end = _PHONE.match(text, plus + 2).end()
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return end if end > plus + 3 and text[end - 1] in _DIGITS else None


def _login(text: str, colon: int):
    start = _run_start(text, colon, 0, _WORD | frozenset("+.-"))
    end = _AUTHORITY.match(text, colon + 3).end()
    sign = text.rfind("@", colon + 3, end)
    if start < colon and text[start].isalpha() and colon + 3 < sign < end - 1:
        return start, end
    return None


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every span, by kind and start."""
    out, behind = [], [0] * len(KINDS)

    def take(kind: str, start: int, end: int) -> None:
        out.append((KINDS.index(kind), start, end))

    mail = points = card = phone = login = 0
    for last, (anchor, size) in _anchors().iter(text):
        at = last + 1 - size
        if anchor == "9":
            if at >= card:
                card = _CARD.match(text, at).end()
                digits = text[at:card].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    take("card", at, card)
        elif anchor == ".":
            if at >= points:
                start = _run_start(text, at, points, _DIGITS)
                points = _POINTS.match(text, start).end()
                for span in _ips(text, start, points):
                    take("ip", *span)
        elif anchor == "@":
            span = _email(text, at, mail)
            if span:
                mail = span[1]
                take("email", *span)
        elif anchor == "+":
            end = _phone(text, at) if at >= phone else None
            if end:
                phone = end
                if 8 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
                    take("phone", at, end)
        elif anchor == "://":
            span = _login(text, at) if at >= login else None
            if span:
                login = span[1]
                take("login", *span)
        elif at == 0 or text[at - 1] not in _WORD:
            k = KINDS.index(anchor)
            found = (_IBAN if anchor == "iban" else _ACCOUNT).match(text, at + size)
            if found and at >= behind[k]:
                value = found[1]
                behind[k] = found.end(1)
                low, high = ACCOUNT_DIGITS
                if iban_holds(value) if anchor == "iban" else (
                        low <= sum(c in _DIGITS for c in value) <= high):
                    take(anchor, found.start(1), found.end(1))
    return sorted(out)


_SPANS = "array<struct<kind:string,start:long,end:long>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(batches):
    for piece in pieces(batches):
        spans = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in find_spans(t or "")]
                 for t in piece.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(spans, _TYPE)], ["doc_id", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: every document's spans, by kind and start."""
    return docs.select("doc_id", "text").mapInArrow(_find, f"doc_id long, spans {_SPANS}")


def masked(docs: DataFrame, mask: str = "[{kind}]") -> DataFrame:
    """``doc_id, text`` with every span replaced by ``mask``; where spans of several
    kinds overlap, the one that starts first stands (the longer one of a tie)."""
    def run(batches):
        for piece in pieces(batches):
            texts = []
            for t in piece.column("text").to_pylist():
                out, at = [], 0
                for k, a, b in sorted(find_spans(t or ""), key=lambda s: (s[1], -s[2])):
                    if a >= at:
                        out += [t[at:a], mask.format(kind=KINDS[k])]
                        at = b
                texts.append(t if t is None else "".join(out) + t[at:])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def spans_string(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter(spans, lambda s: s["kind"].isin(*KINDS[:BASE]))
    return find_personal_data(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in KINDS[:BASE]],
        F.sha2(spans_string(base).cast("binary"), 256).alias("base_sha256"),
        spans_string(spans).alias("spans"))
