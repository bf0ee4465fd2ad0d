"""Conversation structure repair (operator 12).

The cheapest edits (Keep 0, Rerole 1, Delete 2, Insert 5, and 5 more for a kept
truncated turn) that give a conversation the roles ``(s?(ua)+)?`` are found with
Four-Russians block tables. Read from its end, a conversation is a column of four
costs, one for each state of that pattern (nothing yet, after s, after u, after a):
the cost of the rest from there. Less its smallest cost, only a few such vectors
occur. For every one of them and every block of ``BLOCK`` turn symbols, a table
holds the vector before the block and the cost that was taken off. So a
conversation is one lookup a block, from the last to the first. The edits are then
traced forwards: each block is expanded backward from the vector at its right end,
and of the edits that keep to the cheapest cost the one with the least letter is
taken (D, I, K, R), which gives the least audit among all cheapest ones.

Conversations are range-sorted by id and turn, and each task streams its range,
holding one conversation or one piece of ``PIECE_ROWS`` turns or ``PIECE_BYTES``
bytes. The first and the last conversation of a range, and those of several
pieces, may have turns elsewhere: their pieces are joined in Spark, the vectors
from right to left, then the states from left to right, one piece in memory.

Defined results: a conversation without id is one conversation; turns that tie are
in the order of a hash of role and text; a turn that is there twice is a duplicate
the second time; NULL role or text is one space; an empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import SPACES, Scratch, importable

BLOCK = 4
PIECE_ROWS, PIECE_BYTES = 4096, 4 << 20
#: Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = "sua"
#: Symbols: 0 a turn that must go, 1 + 2 * role + truncated, and a pad that changes nothing.
SYMBOLS, PAD = 10, 9
#: By state: the state after an inserted or renamed turn, and the roles that may be kept.
STEP = (2, 2, 3, 2)
KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
END = (0, 2 * INSERT, INSERT, 0)
NAMES = {2: "user", 3: "assistant"}


def _before(after: tuple, symbol: int) -> tuple:
    """Costs by state ahead of a turn, from the costs behind it."""
    if symbol == PAD:
        return after
    costs = [DELETE + c for c in after]
    if symbol:
        role, late = divmod(symbol - 1, 2)
        for q in range(4):
            costs[q] = min(costs[q], RENAME + TRUNCATED * late + after[STEP[q]])
            if role in KEEP[q]:
                costs[q] = min(costs[q], TRUNCATED * late + after[KEEP[q][role]])
    for _ in range(3):
        costs = [min(c, INSERT + costs[STEP[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """The vectors that occur, and for each with each block the vector before it."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, number = [END], {END: 0}
        step, taken = [], []
        for vector in self.vectors:        # grows as new ones are met
            step.append([])
            taken.append([])
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in number:
                    number[costs] = len(self.vectors)
                    self.vectors.append(costs)
                step[-1].append(number[costs])
                taken[-1].append(least)
        step, taken = np.array(step, dtype=np.int32), np.array(taken, dtype=np.int64)
        blocks = np.array(list(product(range(SYMBOLS), repeat=block)))
        at = np.repeat(np.arange(len(self.vectors))[:, None], len(blocks), axis=1)
        cost = np.zeros_like(at)
        for place in range(block - 1, -1, -1):
            cost += taken[at, blocks[None, :, place]]
            at = step[at, blocks[None, :, place]]
        self.step, self.taken = at, cost
        self._traced: dict[tuple, tuple[str, int]] = {}

    def codes(self, symbols: bytes) -> list[int]:
        """Numbers of the blocks of ``symbols``, padded in front."""
        lead = -len(symbols) % self.block
        cells = np.concatenate([np.full(lead, PAD), np.frombuffer(symbols, dtype=np.uint8)])
        return (cells.reshape(-1, self.block) @ (SYMBOLS ** np.arange(self.block)[::-1])).tolist()

    def back(self, codes: list[int], vector: int, cost: int) -> tuple[list[int], int, int]:
        """The vector at the right end of each block, then the vector and the cost
        taken off at the left end of all."""
        right = []
        for code in reversed(codes):
            right.append(vector)
            cost += int(self.taken[vector, code])
            vector = int(self.step[vector, code])
        return right[::-1], vector, cost

    def _expand(self, vector: int, code: int, q: int) -> tuple[str, int]:
        """Edits of one block from state ``q``, and the state behind it."""
        symbols = [code // SYMBOLS ** k % SYMBOLS for k in range(self.block - 1, -1, -1)]
        costs = [self.vectors[vector]]
        for s in reversed(symbols):
            costs.append(_before(costs[-1], s))
        costs.reverse()
        edits = []
        for place, s in enumerate(symbols):
            while s != PAD:
                now, after = costs[place], costs[place + 1]
                role, late = divmod(s - 1, 2) if s else (None, 0)
                if now[q] == DELETE + after[q]:
                    edits.append("D")
                    break
                if now[q] == INSERT + now[STEP[q]]:
                    edits.append("I")
                    q = STEP[q]
                    continue
                if role in KEEP[q] and now[q] == TRUNCATED * late + after[KEEP[q][role]]:
                    edits.append("K")
                    q = KEEP[q][role]
                else:
                    edits.append("R")
                    q = STEP[q]
                break
        return "".join(edits), q

    def trace(self, codes: list[int], right: list[int], q: int) -> tuple[str, int]:
        parts = []
        for key in zip(right, codes):
            found = self._traced.get((*key, q))
            if found is None:
                found = self._traced[(*key, q)] = self._expand(*key, q)
            parts.append(found[0])
            q = found[1]
        return "".join(parts), q


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def closing(q: int) -> str:
    """Insertions behind the last turn."""
    return {0: "", 1: "II", 2: "I", 3: ""}[q]


def apply_edits(audit: str, roles: list[str], texts: list[str], q: int = 0) -> tuple[list, list]:
    """Roles and texts after the edits, from state ``q``."""
    out, at = ([], []), 0
    for edit in audit:
        if edit == "K":
            q = KEEP[q][ROLES.find(roles[at][:1])]
            out[0].append(roles[at])
        elif edit != "D":
            q = STEP[q]
            out[0].append(NAMES[q])
        if edit in "KR":
            out[1].append(texts[at])
        elif edit == "I":
            out[1].append("")
        at += edit != "I"
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows as the contract damages them; a
    dropped row stays with 0 copies and no text, a repeated one has 2."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_kind"))
    kind = F.col("_kind")
    text = (F.when(kind < 2, F.lit("")).when(kind == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _symbols(rows: DataFrame) -> DataFrame:
    text, spaces = F.col("text"), F.lit(SPACES)
    end = F.right(F.rtrim(text, spaces), F.lit(1))
    role = F.left("role", F.lit(1))
    role = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    full = 1 + 2 * role + (~end.isin(".", "!", "?")).cast("int")
    return rows.select(
        "conv_id", "turn", "role", "text", "copies", role.alias("initial"),
        F.when(end == "", 0).otherwise(full).alias("symbol"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
        .alias("id"))


STATS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_LISTS = [("turns", pa.list_(pa.int64())), ("ids", pa.list_(pa.string())), ("roles", pa.list_(pa.string())),
          ("texts", pa.list_(pa.string()))]
_SCANNED = pa.schema([
    ("whole", pa.bool_()), ("part", pa.int32()), ("piece", pa.int64()), ("conv_id", pa.int64()),
    *[(s, pa.int64()) for s in (*STATS, "cost")], ("audit", pa.string()),
    ("symbols", pa.binary()), ("initials", pa.binary()), *_LISTS])
SCANNED = ("whole boolean, part int, piece long, conv_id long, gaps long, blank long, duplicate long, "
           "truncated long, illegal long, cost long, audit string, symbols binary, initials binary, "
           "turns array<long>, ids array<string>, roles array<string>, texts array<string>")
REPAIRED = ("conv_id long, piece long, last boolean, gaps long, blank long, duplicate long, "
            "truncated long, illegal long, cost long, audit string, roles array<string>, "
            "texts array<string>")


class _Counts:
    """Faults of a conversation, piece after piece."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.before = None
        self.turns, self.pairs = 0, {(0, 1), (1, 2), (2, 1)}

    def add(self, symbols: bytes, again: set, initials: bytes, turns: list) -> bytes:
        """Counts the turns; the symbols with duplicates as turns that must go."""
        out = bytearray(symbols)
        for i, s in enumerate(symbols):
            if not s:
                self.blank += 1
            elif i in again:
                self.duplicate += 1
                out[i] = 0
            elif s % 2 == 0:
                self.truncated += 1
            if self.before is not None and (self.before, initials[i]) not in self.pairs:
                self.illegal += 1
            self.before = initials[i]
            t = turns[i]
            if t is not None:
                self.turns += t != self.high
                self.high, self.low = t, t if self.low is None else self.low
        return bytes(out)

    def stats(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


class _Piece:
    """Turns of one conversation in order."""

    def __init__(self, conv_id):
        self.conv_id, self.bytes = conv_id, 0
        self.symbols, self.initials = bytearray(), bytearray()
        self.turns, self.ids, self.roles, self.texts = [], [], [], []

    def add(self, turn, role, text, initial, symbol, turn_id) -> None:
        self.symbols.append(symbol)
        self.initials.append(initial)
        for held, value in zip((self.turns, self.ids, self.roles, self.texts), (turn, turn_id, role, text)):
            held.append(value)
        self.bytes += len(text) + len(role)

    def as_piece(self, part: int, piece: int) -> list:
        return [False, part, piece, self.conv_id, *[None] * (len(STATS) + 2), bytes(self.symbols),
                bytes(self.initials), self.turns, self.ids, self.roles, self.texts]

    def as_whole(self, part: int, piece: int, t: Tables) -> list:
        seen, again = set(), set()
        for i, turn_id in enumerate(self.ids):
            again.add(i) if turn_id in seen else seen.add(turn_id)
        counts = _Counts()
        symbols = counts.add(bytes(self.symbols), again, bytes(self.initials), self.turns)
        codes = t.codes(symbols)
        right, vector, cost = t.back(codes, 0, 0)
        audit, q = t.trace(codes, right, 0)
        audit += closing(q)
        return [True, part, piece, self.conv_id, *counts.stats(), cost + t.vectors[vector][0], audit,
                None, None, None, None, *apply_edits(audit, self.roles, self.texts)]


def _batches(rows, schema, most: int = 256, size=lambda r: sum(map(len, r[-1] or ()))):
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += size(r)
        if len(held) >= most or total >= PIECE_BYTES:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _scan(block: int, piece_rows: int):
    def run(batches):
        from pyspark import TaskContext

        part, t = TaskContext.get().partitionId(), tables(block)

        def rows():
            now, n, alone = None, 0, False
            for b in batches:
                cols = [b.column(c).to_pylist() for c in (
                    "conv_id", "copies", "turn", "role", "text", "initial", "symbol", "id")]
                for conv_id, copies, *turn in zip(*cols):
                    if now is None or conv_id != now.conv_id:
                        if now is not None:
                            # the first conversation, and the rest of a divided one, is a piece
                            yield now.as_whole(part, n, t) if alone else now.as_piece(part, n)
                            n += 1
                        alone, now = now is not None, _Piece(conv_id)
                    for _ in range(copies):
                        if len(now.turns) >= piece_rows or now.bytes >= PIECE_BYTES:
                            yield now.as_piece(part, n)
                            n += 1
                            alone, now = False, _Piece(conv_id)
                        now.add(*turn)
            if now is not None:
                yield now.as_piece(part, n)

        yield from _batches(rows(), _SCANNED)
    return run


def _rows(batches, names):
    for b in batches:
        yield from zip(*[b.column(c).to_pylist() for c in names])


_VECTORS = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("vector", pa.int32()),
                      ("last", pa.bool_()), ("cost", pa.int64())])


def _vectors(block: int):
    """The vector at the right end of each piece; the pieces of a conversation come
    from the last to the first."""
    def run(batches):
        def rows():
            t, before = tables(block), ()
            for conv_id, part, piece, symbols, again in _rows(
                    batches, ("conv_id", "part", "piece", "symbols", "again")):
                last = before != (conv_id,)
                if last:
                    before, vector, cost = (conv_id,), 0, 0
                out = bytearray(symbols)
                for i in again or ():
                    out[i] = 0
                right, (_, vector, cost) = vector, t.back(t.codes(bytes(out)), vector, cost)
                yield part, piece, right, last, cost + t.vectors[vector][0]
        yield from _batches(rows(), _VECTORS, 10_000, lambda r: 0)
    return run


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()),
                       *[(s, pa.int64()) for s in (*STATS, "cost")], ("audit", pa.string()),
                       ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _traces(block: int):
    """The edits of each piece; the pieces of a conversation come in order."""
    def run(batches):
        def rows():
            t, before = tables(block), ()
            for conv_id, symbols, again, initials, turns, roles, texts, vector, last, cost in _rows(
                    batches, ("conv_id", "symbols", "again", "initials", "turns", "roles", "texts",
                              "vector", "last", "cost")):
                if before != (conv_id,):
                    before, counts, q, n, total = (conv_id,), _Counts(), 0, 0, cost
                symbols = counts.add(symbols, set(again or ()), initials, turns)
                codes = t.codes(symbols)
                audit, after = t.trace(codes, t.back(codes, vector, 0)[0], q)
                if last:
                    audit += closing(after)
                yield (conv_id, n, last, *counts.stats(), total, audit, *apply_edits(audit, roles, texts, q))
                q, n = after, n + 1
        yield from _batches(rows(), _REPAIRED)
    return run


def repair(rows: DataFrame, block: int = BLOCK, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired conversations from rows ``conv_id, turn, role, text, copies``.

    A row per conversation, or per piece of a long one (``piece`` from 0, the last
    one marked): faults and cost up to there (those of the last piece are the
    conversation's), the letters of the edits, and the roles and texts after them.
    """
    scratch = Scratch(rows.sparkSession, "structure-repair")
    order = [F.col("conv_id"), F.col("turn"), F.col("id")]
    scanned = scratch.save(_symbols(rows).repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "copies", "turn", "role", "text", "initial", "symbol", "id").mapInArrow(
        _scan(block, piece_rows), SCANNED), "scanned")
    whole = scanned.filter("whole").select(
        "conv_id", F.lit(0).cast("long").alias("piece"), F.lit(True).alias("last"), *STATS, "cost",
        "audit", "roles", "texts")
    pieces = scanned.filter("NOT whole")
    turns = pieces.select("conv_id", "part", "piece", F.posexplode("ids").alias("at", "id"))
    seen = Window.partitionBy("conv_id", "id").orderBy("part", "piece", "at")
    again = scratch.save(turns.withColumn("nth", F.row_number().over(seen)).filter("nth > 1").groupBy(
        "part", "piece").agg(F.collect_list("at").alias("again")), "again")
    pieces = pieces.join(again, ["part", "piece"], "left")
    vectors = scratch.save(
        pieces.select("conv_id", "part", "piece", "symbols", "again").repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("part"), F.desc("piece"))
        .mapInArrow(_vectors(block), "part int, piece long, vector int, last boolean, cost long"),
        "vectors")
    pieces = pieces.select("conv_id", "part", "piece", "symbols", "again", "initials", "turns", "roles",
                           "texts").join(vectors, ["part", "piece"])
    traced = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(
        _traces(block), REPAIRED)
    return scratch.save(whole.unionByName(traced), "repaired")


_DIGESTS = pa.schema([*[(s, pa.int64()) for s in ("conv_id", *STATS, "cost")], ("audit", pa.string()),
                      ("repaired_sha256", pa.string())])


def _digests(batches):
    """Audit and hash of conversations of several pieces, which come in order."""
    def rows():
        for piece, last, audit, roles, texts, *totals in _rows(
                batches, ("piece", "last", "audit", "roles", "texts", "conv_id", *STATS, "cost")):
            if not piece:
                audits, digest, lead = [], hashlib.sha256(), b""
            audits.append(audit)
            for role, text in zip(roles, texts):
                digest.update(lead + f"{role}:{text}".encode())
                lead = b"\n"
            if last:
                yield (*totals, "".join(audits), digest.hexdigest())
    yield from _batches(rows(), _DIGESTS, 10_000, lambda r: len(r[-2]))


COLUMNS = ["conv_id", *STATS, "cost", "audit", "repaired_sha256"]


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit and the hash of the repaired turns."""
    alone = F.expr("piece = 0 AND last")
    lines = F.transform(F.arrays_zip("roles", "texts"),
                        lambda z: F.concat(z["roles"], F.lit(":"), z["texts"]))
    one = repaired.filter(alone).withColumn(
        "repaired_sha256", F.sha2(F.array_join(lines, "\n").cast("binary"), 256)).select(*COLUMNS)
    many = repaired.filter(~alone).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return one.unionByName(many.mapInArrow(_digests, one.schema))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return digests(repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
