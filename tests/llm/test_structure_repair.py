"""Structure repair against brute force, with tables of several block lengths."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from visitlens.llm import structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string"
GOAL = re.compile("(s?(ua)+)?")


def cheapest(turns):
    """Least (cost, audit, result) by suffixes; ``turns`` are (initial, must go, truncated)."""
    nxt = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    memo = {}

    def best(i, state, inserted):
        key = (i, state, inserted)
        if key in memo:
            return memo[key]
        found = []
        if i == len(turns):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            initial, gone, late = turns[i]
            c, s = best(i + 1, state, 0)
            found.append((c + 2, "D" + s))
            if not gone:
                if initial in nxt[state]:
                    c, s = best(i + 1, initial, 0)
                    found.append((c + 5 * late, "K" + s))
                for r in "ua":
                    if r in nxt[state]:
                        c, s = best(i + 1, r, 0)
                        found.append((c + 1 + 5 * late, "R" + s))
        if inserted < 3:
            for r in "ua":
                if r in nxt[state]:
                    c, s = best(i, r, inserted + 1)
                    found.append((c + 5, "I" + s))
        memo[key] = min(found, default=(10**9, ""))
        return memo[key]

    return best(0, "", 0)


def exhaustive(turns):
    """All scripts with at most two insertions a gap, for a few turns."""
    found = []
    gaps = [["", "u", "a", "ua", "au"]] * (len(turns) + 1)
    for inserts in itertools.product(*gaps):
        for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(turns)):
            cost, roles, audit = 0, "", ""
            for i in range(len(turns) + 1):
                roles, audit, cost = roles + inserts[i], audit + "I" * len(inserts[i]), cost + 5 * len(inserts[i])
                if i < len(turns):
                    initial, gone, late = turns[i]
                    if gone and edits[i] != "D":
                        break
                    cost += {"D": 2, "K": 0}.get(edits[i], 1) + (5 * late if edits[i] != "D" else 0)
                    roles += {"D": "", "K": initial if initial in ("s", "u", "a") else "?"}.get(edits[i], edits[i][1:])
                    audit += edits[i][0]
            else:
                if GOAL.fullmatch(roles):
                    found.append((cost, audit))
    return min(found)


def brute_force(rows):
    ids, turns = {}, collections.defaultdict(list)
    for c, turn, role, text in rows:
        ids[c] = True
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        turns[c] += [((turn is not None, turn or 0, tie), turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    out = []
    for c in ids:
        rows_c = [r[1:] for r in sorted(turns[c])]
        seen, faults, spec = set(), collections.Counter(), []
        for _, role, text in rows_c:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            faults[fault] += 1
            spec.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        known = [t for t, _, _ in rows_c if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(spec, spec[1:]))
        cost, audit = cheapest(spec)
        if len(spec) <= 3:
            assert exhaustive(spec) == (cost, audit)
        kept, state, at = [], "", 0
        for e in audit:
            role, text = rows_c[at][1:] if e != "I" else ("", "")
            if e != "D":
                name = role if e == "K" else "assistant" if state == "u" else "user"
                kept.append(f"{name}:{text}")
                state = name[0]
            at += e != "I"
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost,
                    audit, sha))
    return sorted(out, key=str)


def table(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "  ", "", None, "End? \n", "ünï.", "same.", "x" * 50]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = []
    for c in [None, *range(-3, 150)]:
        for t in range(rng.choice([1, 2, 3, 4, 6, 9])):
            turn = rng.choice([t, t, t + 1, None])
            rows.append((c, turn, rng.choice(roles) if rng.random() < .5 else roles[t % 2], rng.choice(texts)))
    rows += [(500, t, ["user", "assistant"][t % 2], f"turn {t % 50}.") for t in range(300)]
    rows += [(501, 5, "user", "tie."), (501, 5, "user", "tie."), (501, 5, "assistant", "tie.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,piece_rows", [(4, 4096), (1, 3), (3, 7)])
def test_repair_equals_brute_force(spark, block, piece_rows):
    rows = table(block)
    extra = spark.createDataFrame([(*r, 7, "x", "y") for r in rows],
                                  SCHEMA + ", piece int, copies string, _kind string").repartition(3)
    got = sr.digests(sr.repair(sr.damaged(extra), block, piece_rows))
    assert got.columns == sr.COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_every_block_gives_the_costs_of_its_single_steps():
    t, one = sr.Tables(3), sr.Tables(1)
    assert len(t.vectors) < 200
    rng = random.Random(1)
    for _ in range(300):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randint(0, 17)))
        a = t.back(t.codes(symbols), 0, 0)[1:]
        assert a == one.back(one.codes(symbols), 0, 0)[1:]


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    out = sr.op12(spark, str(tmp_path))
    assert out.columns == sr.COLUMNS and out.count() == 0
