"""Benchmark decontamination by a prefix-filtered set join (operator 10).

Windows of ``WINDOW`` consecutive words of the benchmark items are the shingles that
are looked for in all documents. Words are ordered by rarity, counted as their places
in the whole corpus; as a window must be held whole, its rarest word is the one
necessary prefix token, and only places of that word in a document are candidates. A
candidate fixes where the window would begin (positional bound); it must not begin
before the document or end behind it (length bound). Windows and candidates are
tables: the windows are made, counted and ordered in Spark, candidates are joined to
them by the words themselves, which verifies each exactly, and what a document is hit
by is grouped from the joined rows. Neither side goes through the driver.

So that only likely candidates are written, tasks hold three bit filters made from
the windows: rarest words, their places in windows, and hashes of whole windows. Their
size follows the number of windows up to ``MOST_BITS`` bits each; a fuller filter lets
more candidates through to the join and changes no result. Documents are hashed and
looked through in blocks of ``CHUNK_BYTES`` bytes and ``block_words`` words, whatever
the length of a text.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased. Defined results: NULL text has no words; an item without words has
no window; items that lack an ``item_id`` give hit words but no item; items that
repeat an id are one item; rows that repeat a ``doc_id`` are documents of their own;
empty tables give no rows, or rows without hits; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Scratch, documents
from visitlens.operators.joins import broadcast_if_bounded

WINDOW = 10
#: Document words that are looked through at once, and bytes that are hashed at once.
BLOCK_WORDS, CHUNK_BYTES = 1 << 18, 1 << 20
#: Bits of a filter: for each entry, and at most (16 MB).
ENTRY_BITS, LEAST_BITS, MOST_BITS, BLOB_BITS = 6, 16, 27, 16
#: Windows up to this number (and 256 MB) are broadcast to the candidates.
FEW_WINDOWS = 1_000_000
#: Distinct words that a counting task holds before it passes them on.
MOST_WORDS = 1_000_000
_KEPT = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
              else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
_U = np.uint64
_ODD, _MIX = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX
    return h ^ (h >> _U(29))


#: A number for every byte of a word, none for the bytes between words.
_LETTER = np.where(np.frombuffer(bytes(range(256)).translate(_KEPT), np.uint8) == 32, _U(0),
                   _mixed(np.arange(1, 257, dtype=_U) * _ODD))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_KEPT).split()


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as needed."""

    def __init__(self):
        self.of = self.inverse = np.zeros(0, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.of) < n:
            back = pow(int(_ODD), -1, 1 << 64)
            self.of, self.inverse = (np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, b, _U)]), dtype=_U)
                                     for b in (_ODD, _U(back)))
        return self.of[:n], self.inverse


_POWERS = _Powers()


def hashed(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased text, starts, ends, hashes) of the words of a text in UTF-8."""
    low = data.translate(_KEPT)
    found: list[tuple] = []
    a = 0
    while a < len(low):
        b = low.find(b" ", a + CHUNK_BYTES)     # a chunk ends between words
        b = len(low) if b < 0 else b
        part = np.frombuffer(low, np.uint8, b - a, a)
        inside = np.zeros(len(part) + 2, dtype=bool)
        inside[1:-1] = part != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            power, inverse = _POWERS.upto(len(part))
            sums = np.add.reduceat(_LETTER[part] * power, starts)
            found.append((starts + a, ends + a, _mixed(sums * inverse[starts])))
        a = b
    if not found:
        none = np.zeros(0, np.int64)
        return low, none, none, np.zeros(0, _U)
    return low, *(np.concatenate(c) for c in zip(*found))


def _window_hash(h: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    out = np.full(len(begin), length, dtype=_U)
    for k in range(length):
        out = out * _ODD + h[begin + k]
    return _mixed(out)


def _placed(rare: np.ndarray, offset, length) -> np.ndarray:
    """Hash of a window's rarest word with its place and the window's length."""
    place = np.atleast_1d(np.multiply(offset, 1 << 32) + length).astype(_U)
    return _mixed(rare + _U(1) + place * _ODD)


class Filter:
    """A set of hashes as bits; it may hold others too."""

    def __init__(self, bits: int, cells: bytes):
        self.bits, self.cells = bits, np.frombuffer(cells, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> _U(64 - self.bits)
        return (self.cells[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8)) & 1 > 0


def _blobs(batches):
    """Blocks of a filter from their slots, which come block by block."""
    now, cells = None, None
    size = 1 << (BLOB_BITS - 3)

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([cells.tobytes()])],
                                          ["blob", "cells"])

    for batch in batches:
        blobs, slots = (batch.column(c).to_numpy() for c in ("blob", "slot"))
        for blob in np.unique(blobs):
            if blob != now:
                if now is not None:
                    yield row()
                now, cells = int(blob), np.zeros(size, np.uint8)
            own = slots[blobs == blob]
            np.bitwise_or.at(cells, own >> 3, (1 << (own & 7)).astype(np.uint8))
    if now is not None:
        yield row()


def _filter(hashes: DataFrame, bits: int):
    """A broadcast ``Filter`` of the column ``h``: at most 2^MOST_BITS bits in blobs."""
    slot = F.shiftrightunsigned("h", 64 - bits)
    blobs = hashes.select(F.shiftright(slot, BLOB_BITS).alias("blob"),
                          slot.bitwiseAND(F.lit((1 << BLOB_BITS) - 1)).alias("slot"))
    blobs = blobs.repartition("blob").sortWithinPartitions("blob").mapInArrow(
        _blobs, "blob long, cells binary")
    cells = bytearray(1 << (bits - 3))
    size = 1 << (BLOB_BITS - 3)
    for r in blobs.collect():
        cells[r["blob"] * size:(r["blob"] + 1) * size] = bytes(r["cells"])
    return hashes.sparkSession.sparkContext.broadcast(Filter(bits, bytes(cells)))


def _windows(window: int):
    def run(batches):
        names = ["item_id", "window", "hash", "length", "words"]

        def rows(cols):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64())))], names)

        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for item_id, text in zip(*[batch.column(c).to_pylist() for c in ("item_id", "text")]):
                low, starts, ends, h = hashed((text or "").encode())
                length = min(window, len(h))
                begin = np.arange(len(h) - length + 1 if length else 0)
                signed = h.astype(np.int64).tolist()
                for b, wh in zip(begin.tolist(), _window_hash(h, begin, length).astype(np.int64).tolist()):
                    own = b" ".join([low[starts[k]:ends[k]] for k in range(b, b + length)])
                    for c, v in zip(cols, (item_id, own.decode(), wh, length, signed[b:b + length])):
                        c.append(v)
                    if len(cols[0]) >= 10_000:
                        yield rows(cols)
                        cols = [[] for _ in names]
            yield rows(cols)
    return run


def _slices(batches):
    """Batches in slices of about CHUNK_BYTES bytes of text, or one row."""
    for batch in batches:
        sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column("text")]
        start, size = 0, 0
        for i, n in enumerate(sizes):
            if i > start and size + n > CHUNK_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(sizes):
            yield batch.slice(start)


def _texts(batch) -> tuple[bytes, np.ndarray]:
    """The texts of a slice as one, a space between any two, and where each begins."""
    texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return b" ".join(texts), at


def _counted(wanted):
    """Places of the wanted words in the texts, by hash."""
    def run(batches):
        def merged(h, n):
            h, n = np.concatenate(h), np.concatenate(n)
            keys, at = np.unique(h, return_inverse=True)
            return [keys], [np.bincount(at, n, len(keys)).astype(np.int64)]

        def rows(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], ["word", "n"])

        held, counts, size = [], [], 0
        for batch in _slices(batches):
            h = hashed(_texts(batch)[0])[3]
            own, n = np.unique(h[wanted.value.has(h)], return_counts=True)
            held.append(own)
            counts.append(n.astype(np.int64))
            size += len(own)
            if size > 2 * MOST_WORDS:
                held, counts = merged(held, counts)
                size = len(held[0])
                if size > MOST_WORDS:
                    yield rows(held[0], counts[0])
                    held, counts, size = [], [], 0
        if held:
            held, counts = merged(held, counts)
            yield rows(held[0], counts[0])
    return run


_CANDIDATES = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                         ("a", pa.int64()), ("b", pa.int64()), ("window", pa.string())])
CANDIDATES = "key string, doc_id long, n_words long, a long, b long, window string"


def _candidates(rarest, placed, whole, lengths: list[int], block_words: int):
    """A row per text (its words counted, no window), and a row per candidate."""
    def run(batches):
        for batch in _slices(batches):
            data, at = _texts(batch)
            low, starts, ends, h = hashed(data)
            first = np.searchsorted(starts, at)         # first word of each text
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(np.diff(first), pa.int64()),
                 *[pa.nulls(rows, f.type) for f in list(_CANDIDATES)[3:]]], schema=_CANDIDATES)
            keys = batch.column("key")
            for block in range(0, len(h), block_words):
                places = np.flatnonzero(rarest.value.has(h[block:block + block_words])) + block
                if not len(places):
                    continue
                text = np.searchsorted(first, places, "right") - 1
                for length in lengths:
                    for offset in range(length):
                        begin = places - offset
                        fits = ((begin >= first[text]) & (begin + length <= first[text + 1])
                                & placed.value.has(_placed(h[places], offset, length)))
                        begin, of = begin[fits], text[fits]
                        if not len(begin):
                            continue
                        likely = whole.value.has(_window_hash(h, begin, length))
                        begin, of = begin[likely], of[likely]
                        if not len(begin):
                            continue
                        found = [b" ".join([low[s:e] for s, e in zip(
                            starts[b:b + length].tolist(), ends[b:b + length].tolist())]).decode()
                            for b in begin.tolist()]
                        n, place = len(begin), begin - first[of]
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(of)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                             pa.array(place), pa.array(place + length), pa.array(found, pa.string())],
                            schema=_CANDIDATES)
    return run


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, window, hash, length, words``: the windows of every item, the words
    as one text and as hashes."""
    return benchmark.select("item_id", "text").mapInArrow(
        _windows(window), "item_id long, window string, hash long, length int, words array<long>")


def _joined(texts: DataFrame, benchmark: DataFrame, window: int, block_words: int):
    """(rows of all texts and candidates, candidates that are windows, windows of items).

    ``texts`` holds ``key``, ``doc_id`` and ``text``.
    """
    scratch = Scratch(texts.sparkSession, "decontamination")
    made = scratch.save(windows(benchmark, window), "windows")
    distinct = scratch.save(made.groupBy("window").agg(
        *[F.first(c).alias(c) for c in ("hash", "length", "words")]), "distinct")
    # one row per length, of which there are at most `window`
    lengths = {r["length"]: r["n"] for r in distinct.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(1 + sum(lengths.values()))) + ENTRY_BITS))

    placed = distinct.select("window", "length", F.posexplode("words").alias("offset", "word"))
    wanted = _filter(placed.select(F.col("word").alias("h")).distinct(), bits)
    counts = texts.select("text").mapInArrow(_counted(wanted), "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    rarest = placed.join(counts, "word", "left").groupBy("window").agg(
        F.first("length").alias("length"),
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rare"))
    rarest = scratch.save(rarest.select("rare.word", "rare.offset", "length").distinct(), "rarest")

    def hashes(batches):
        for batch in batches:
            word, offset, length = (batch.column(c).to_numpy().astype(np.int64)
                                    for c in ("word", "offset", "length"))
            h = _placed(word.astype(_U), offset, length)
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64))], ["h"])

    filters = (_filter(rarest.select(F.col("word").alias("h")).distinct(), bits),
               _filter(rarest.mapInArrow(hashes, "h long"), bits),
               _filter(distinct.select(F.col("hash").alias("h")), bits))
    found = scratch.save(texts.mapInArrow(
        _candidates(*filters, sorted(lengths), block_words), CANDIDATES), "candidates")
    own = broadcast_if_bounded(distinct.select("window"), FEW_WINDOWS)
    hits = found.filter("window IS NOT NULL").select("key", "a", "b", "window").join(
        own, "window", "left_semi")
    return found, scratch.save(hits, "hits"), made.select("item_id", "window").distinct()


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row, doc_id, n_words, ranges, items`` of every document: where windows of
    the benchmark occur (word places, end exclusive) and of which items."""
    texts = docs.select(F.monotonically_increasing_id().cast("string").alias("key"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, hits, of_items = _joined(texts, benchmark, window, block_words)
    ranges = hits.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
    of_items = broadcast_if_bounded(of_items.filter("item_id IS NOT NULL"), FEW_WINDOWS)
    items = hits.select("key", "window").distinct().join(of_items, "window").groupBy("key").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>"), F.array().cast("array<bigint>")
    return found.filter("window IS NULL").select("key", "doc_id", "n_words").join(
        ranges, "key", "left").join(items, "key", "left").select(
        F.col("key").cast("long").alias("row"), "doc_id", "n_words",
        F.coalesce("ranges", none[0]).alias("ranges"), F.coalesce("items", none[1]).alias("items"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, as they are.

    As that depends on the text alone, the texts that hold one go by their digest.
    """
    digest = F.sha2(F.col("text").cast("binary"), 256)
    texts = docs.filter("text IS NOT NULL").select(
        digest.alias("key"), F.lit(None).cast("long").alias("doc_id"), "text")
    hits = _joined(texts, benchmark, window, block_words)[1].select(F.col("key").alias("_hit")).distinct()
    hits = broadcast_if_bounded(hits, FEW_WINDOWS)
    return docs.join(hits, digest == hits["_hit"], "left_anti")


def hit_words(ranges: F.Column) -> F.Column:
    """Words that any of the ranges covers."""
    step = F.aggregate(
        F.array_sort(ranges), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["b"] - F.greatest(r["a"], s["to"]))).alias("n"),
            F.greatest(s["to"], r["b"]).alias("to")))
    return step["n"]


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    hits = hit_words(F.col("ranges"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))
