"""Conversation prefix trie (operator 11).

Every conversation is a row of turn ids (16-byte hashes of role and text). The
rows are range-sorted by their ids, so the members of every node of the trie lie
together, and each task takes its range in blocks: a block's ids are a padded
matrix, ``numpy.lexsort`` orders it, and the places where a column differs from
the row above, OR-accumulated from the first column on, are the starts of the
nodes of each depth. ``reduceat`` over these starts gives members, children,
leaves and subtree sums, from the deepest column upwards.

Only the nodes on the path of a block's first or last row can have members in
other blocks. They are left as partial rows, one for each node of the two paths,
and recombine in Spark: partials are grouped by node, what a merged node adds to
its ancestors is a running sum along one path that holds it, and these sums are
grouped again. Their number grows with the number of blocks and the length of
their paths, not with members; nothing is collected.

A matrix has at most ``CELLS`` cells, or one row. Copies of one conversation and
conversations with one beginning are divided among blocks as any others, by
``conv_id``. A row holds 20 bytes a turn of one conversation and no text, so the
turns of a single conversation are what one task must hold.

Defined results: rows without ``conv_id`` belong to no conversation; null role or
text is empty; turns that tie are ordered by the hash of role and text; a repeated
turn is a turn of its own; an empty table has no nodes, not even a root; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import Scratch, importable
from visitlens.operators.joins import has_at_most

#: Turns that copies of one beginning are dealt from (the contract's rebuild).
GROUP, MOST_SHARED = 20, 3
CELLS = 1 << 18
ID_BYTES = 16
#: Merged boundary nodes up to this number are broadcast.
FEW_NODES = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("kind string, part int, block long, side int, depth int, node binary, parent binary, "
        "conv_id long, parent_conv_id long, n_convs long, longest long, n_children long, "
        "n_leaves long, saved_tokens long, words long, first boolean, ends string")
_ARROW = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("side", pa.int32()),
    ("depth", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("longest", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("words", pa.int64()), ("first", pa.bool_()), ("ends", pa.string())])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as structs (id, words)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn_id = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", F.struct(F.col("turn").alias("turn"), turn_id.alias("id"), words.alias("words"))
        .alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["id"], t["words"])).alias("turns"))


def with_shared_beginnings(lists: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % 20 in place
    of its own first h, h being crc32(c) % 4."""
    first = lists.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, MOST_SHARED).alias("_first"))
    own = lists.withColumns({
        "_group": F.col("conv_id") - F.col("conv_id") % GROUP,
        "_h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")})
    none = F.slice("turns", 1, 0)
    rebuilt = F.concat(F.coalesce(F.slice("_first", F.lit(1), F.col("_h")), none),
                       F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(first, F.col("_group") == F.col("_base"), "left").select(
        "conv_id", rebuilt.alias("turns"))


def _path(key: bytes, depth: int) -> list[bytes]:
    """Ids of the nodes on a row's path, root first: hashes of its beginnings."""
    digest, out = hashlib.md5(), [hashlib.md5().digest()]
    for d in range(depth):
        digest.update(key[ID_BYTES * d:ID_BYTES * (d + 1)])
        out.append(digest.copy().digest())
    return out


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def block_nodes(conv: np.ndarray, keys: list[bytes], lengths: np.ndarray, words: np.ndarray):
    """The nodes of a block of conversations, and the partial nodes on its two edges.

    ``words`` holds the word counts of all rows one after another. Yields dicts of
    the columns of ``NODE`` without ``part`` and ``block``, one dict for each depth,
    then one for each edge.
    """
    n, wide = len(conv), int(lengths.max(initial=0))
    inside = np.arange(wide) < lengths[:, None]
    flat = np.frombuffer(b"".join(keys), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    high, low, count = (np.zeros((n, wide), dtype=t) for t in (np.uint64, np.uint64, np.int64))
    high[inside], low[inside], count[inside] = flat[:, 0], flat[:, 1], words
    columns = [c for d in range(wide) for c in (inside[:, d], high[:, d], low[:, d])]
    order = np.lexsort([conv, *columns[::-1]])
    conv, lengths, inside = conv[order], lengths[order], inside[order]
    high, low, count = high[order], low[order], count[order]

    differs = np.ones((n, wide), dtype=bool)
    differs[1:] = ((high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (inside[1:] != inside[:-1]))
    change = np.logical_or.accumulate(differs, axis=1)

    saved, leaves, starts = (np.zeros(n, dtype=np.int64) for _ in range(3))
    one = np.ones(n, dtype=np.int64)
    levels = []
    for depth in range(wide, -1, -1):
        if depth:
            at = np.flatnonzero(change[:, depth - 1])
            real, word = inside[at, depth - 1], count[at, depth - 1]
        else:
            at, real, word = np.zeros(1, dtype=np.int64), np.ones(1, dtype=bool), np.zeros(1, np.int64)

        def over(values, fold=np.add, at=at, real=real):
            return fold.reduceat(values, at)[real]

        ended = (lengths == depth).astype(np.int64)
        level = {"depth": depth, "at": at[real], "to": np.append(at[1:], n)[real], "words": word[real],
                 "conv_id": over(conv, np.minimum), "n_convs": over(one), "longest": over(lengths, np.maximum),
                 "n_children": over(starts), "n_leaves": over(leaves), "saved_tokens": over(saved),
                 "n_ends": over(ended)}
        # what lies on an edge is added when its parts are merged
        level["edge"] = (level["at"] == 0) | (level["to"] == n)
        gain = np.where(level["edge"], 0, (level["n_convs"] - 1) * level["words"])
        leaf = np.where(level["edge"], 0, level["longest"] == depth)
        level["saved_tokens"] = level["saved_tokens"] + gain
        level["n_leaves"] = level["n_leaves"] + leaf
        saved[level["at"]] += gain
        leaves[level["at"]] += leaf
        starts = np.zeros(n, dtype=np.int64)
        starts[level["at"]] = level["at"] > 0
        levels.append(level)
    levels.reverse()

    for depth in range(1, wide + 1):
        level, above = levels[depth], levels[depth - 1]
        mine = np.flatnonzero(~level["edge"])
        if not len(mine):
            continue
        up = np.searchsorted(above["at"], level["at"][mine], "right") - 1
        lost = above["edge"][up]
        # a parent on the first row's path is looked up there, else on the last row's
        side = np.where(lost, np.where(above["at"][up] == 0, 0, 1), -1)
        ends = [_sha(conv[a:a + e]) if e else NO_ENDS
                for a, e in zip(level["at"][mine].tolist(), level["n_ends"][mine].tolist())]
        yield {"kind": ["node"] * len(mine), "side": side, "depth": [depth] * len(mine),
               "parent_conv_id": pa.array(above["conv_id"][up], mask=lost), "ends": ends,
               **{c: level[c][mine] for c in ("conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens")}}

    for side, row in ((0, 0), (1, n - 1)):
        key = keys[int(order[row])]
        path = _path(key, int(lengths[row]))
        out = {c: [] for c in _ARROW.names[2:] if c not in ("block", "parent_conv_id")}
        for depth, node in enumerate(path):
            level = levels[depth]
            j = int(np.searchsorted(level["at"], row, "right")) - 1
            first = int(level["at"][j]) == 0
            out["side"].append(side)
            out["depth"].append(depth)
            out["node"].append(node)
            out["parent"].append(path[depth - 1] if depth else None)
            if side and first:      # counted on the first row's path; here only a step of the path
                for c in ("conv_id", "longest", "first", "ends"):
                    out[c].append(None)
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "words"):
                    out[c].append(0)
                continue
            for c in ("conv_id", "n_convs", "longest", "n_children", "n_leaves", "saved_tokens", "words"):
                out[c].append(int(level[c][j]))
            out["first"].append(first)
            a, e = int(level["at"][j]), int(level["n_ends"][j])
            out["ends"].append(",".join(map(str, conv[a:a + e].tolist())) if e else None)
        yield {"kind": ["edge"] * len(path), **out}


def _cuts(lengths: np.ndarray, cells: int):
    """Slices of rows whose padded matrix has at most ``cells`` cells, or one row."""
    start, widest = 0, 0
    for i, n in enumerate(lengths.tolist()):
        widest = max(widest, n, 1)
        if i > start and (i + 1 - start) * widest > cells:
            yield start, i
            start, widest = i, max(n, 1)
    if start < len(lengths):
        yield start, len(lengths)


def _scan(cells: int):
    def run(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column("key").to_pylist()
            conv = batch.column("conv_id").to_numpy()
            lengths = np.array([len(k) // ID_BYTES for k in keys], dtype=np.int64)
            words = batch.column("words").flatten().to_numpy()
            upto = np.concatenate([[0], np.cumsum(lengths)])
            for a, b in _cuts(lengths, cells):
                for cols in block_nodes(conv[a:b], keys[a:b], lengths[a:b], words[upto[a]:upto[b]]):
                    size = len(cols["kind"])
                    arrays = []
                    for f in _ARROW:
                        if f.name in ("part", "block"):
                            arrays.append(pa.array([part if f.name == "part" else block] * size, f.type))
                        elif f.name in cols:
                            v = cols[f.name]
                            arrays.append(v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type))
                        else:
                            arrays.append(pa.nulls(size, f.type))
                    yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)
                block += 1
    return run


def _ends(batches):
    """SHA-256 of each node's ids from its parts, which come in order."""
    node, digest, out = None, None, ([], [])

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1])],
                                          ["node", "ends_sha256"])

    for b in batches:
        for key, ids in zip(b.column("node").to_pylist(), b.column("ends").to_pylist()):
            if key != node:
                if node is not None:
                    out[0].append(node)
                    out[1].append(digest.hexdigest())
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
            if len(out[0]) >= 10_000:
                yield batch()
                out = ([], [])
    if node is not None:
        out[0].append(node)
        out[1].append(digest.hexdigest())
    yield batch()


def _merged_edges(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes on block edges, whole; and ``part, block, side, depth, conv_id`` of
    the nodes of every path."""
    path = ["part", "block", "side"]
    merged = scratch.save(edges.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("longest").alias("longest"),
        F.max("words").alias("words"), F.every("first").alias("unseen"),
        F.min(F.struct(*path)).alias("owner")), "merged")
    of = F.broadcast(merged) if has_at_most(merged.drop("owner"), FEW_NODES) else merged
    steps = edges.select(*path, "node", "n_children", "n_leaves", "saved_tokens").join(of, "node")
    own = F.col("owner") == F.struct(*path)
    down = Window.partitionBy(*path).orderBy(F.desc("depth"))
    below = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def adds(value: Column) -> Column:
        return F.sum(F.when(own, value).otherwise(F.lit(0))).over(below)

    # a node that no part saw begin is a child its parent has not counted
    new_child = F.coalesce(F.lag((own & F.col("unseen")).cast("int")).over(down), F.lit(0))
    steps = scratch.save(steps.select(
        *path, "node", "depth", "conv_id", "n_convs",
        F.lead("conv_id").over(down).alias("parent_conv_id"),
        (F.col("n_children") + new_child).alias("n_children"),
        (F.col("n_leaves") + adds((F.col("longest") == F.col("depth")).cast("int"))).alias("n_leaves"),
        (F.col("saved_tokens") + adds((F.col("n_convs") - 1) * F.col("words"))).alias("saved_tokens")),
        "steps")
    parts = edges.filter("ends IS NOT NULL").select("node", *path, "ends")
    ends = parts.repartition("node").sortWithinPartitions("node", *path).select(
        "node", "ends").mapInArrow(_ends, "node binary, ends_sha256 string")
    whole = steps.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.min("parent_conv_id").alias("parent_conv_id"), F.min("n_convs").alias("n_convs"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    whole = whole.join(ends, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    return whole, steps.select(*path, "depth", "conv_id")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def prefix_trie(lists: DataFrame, cells: int = CELLS) -> DataFrame:
    """The trie of ``lists`` (``conv_id, turns`` of structs id, words): a row per node."""
    scratch = Scratch(lists.sparkSession, "prefix-trie")
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    rows = scratch.save(lists.select(
        "conv_id", F.unhex(ids).alias("key"),
        F.transform("turns", lambda t: t["words"].cast("long")).alias("words")), "rows")
    scanned = scratch.save(
        rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
        .mapInArrow(_scan(cells), NODE), "scanned")
    edges = scanned.filter("kind = 'edge'")
    whole, steps = _merged_edges(scratch, edges)
    nodes = scanned.filter("kind = 'node'").withColumnRenamed("ends", "ends_sha256")
    inner = nodes.filter("side < 0").select(*COLUMNS)
    steps = steps.select("part", "block", "side", (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("_above"))
    outer = nodes.filter("side >= 0").join(steps, ["part", "block", "side", "depth"]).withColumn(
        "parent_conv_id", F.col("_above")).select(*COLUMNS)
    return inner.unionByName(outer).unionByName(whole.select(*COLUMNS))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = prefix_trie(with_shared_beginnings(turn_lists(conversations)))
    return out.withColumn("depth", F.col("depth").cast("long")).select(*COLUMNS)
