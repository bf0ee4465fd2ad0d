"""The prefix trie against brute force, in one block and in many."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from visitlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    out = []
    for node, convs in members.items():
        under = [m for m in members if m[:len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(WORD.findall(m[-1][1])) for m in under if m)
        sha = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    children[node], sum(not children[m] for m in under), saved, sha))
    return sorted(out, key=str)


def table(seed):
    rng = random.Random(seed)
    texts = ["one two", "a  b\tc", "", None, "ü", "same"]
    rows = [(200 + i, t, "user", "same") for i in range(40) for t in range(4)]     # copies
    for c in range(0, 130):
        for t in range(rng.choice([1, 1, 2, 3, 5])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice(texts)))
    rows += [(1003, 0, "user", "alone"), (None, 0, "user", "nobody's"), (77, 0, "user", "tie"),
             (77, 0, "user", "tie")]
    rows += [(2000 + k, t, "u", f"turn {t}") for k in range(2) for t in range(90)]  # long ones
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [1, 12, prefix_trie.CELLS])
def test_trie_equals_brute_force(spark, cells):
    rows = table(cells)
    # columns of the operator's own names, filled with anything
    extra = spark.createDataFrame([(*r, "x", 5, "y") for r in rows],
                                  SCHEMA + ", node string, part int, kind string").repartition(3)
    lists = prefix_trie.with_shared_beginnings(prefix_trie.turn_lists(extra))
    got = [tuple(r) for r in prefix_trie.prefix_trie(lists, cells).collect()]
    assert sorted(got, key=str) == brute_force(rows)


def test_query_and_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    out = prefix_trie.op11(spark, str(tmp_path))
    assert out.columns == prefix_trie.COLUMNS and out.count() == 0
    assert {t for c, t in out.dtypes if c != "ends_sha256"} == {"bigint"}


def test_only_nodes_on_edges_are_partial(spark):
    lists = prefix_trie.turn_lists(spark.createDataFrame(table(1), SCHEMA))
    keys = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    rows = lists.select("conv_id", keys.alias("key"), F.transform(
        "turns", lambda t: t["words"].cast("long")).alias("words")).coalesce(1).sortWithinPartitions(
        "key", "conv_id").mapInArrow(prefix_trie._scan(1 << 18), prefix_trie.NODE).collect()
    edges = [r for r in rows if r.kind == "edge"]
    first = [r for r in edges if r.side == 0]
    last = [r for r in edges if r.side == 1]
    assert len(edges) == len(first) + len(last) and {r.block for r in rows} == {0}
    assert [r.depth for r in first] == list(range(len(first)))
