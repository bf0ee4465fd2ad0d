"""Token ids in seekable Zstandard files (operator 9).

Texts are encoded, an end id is appended to each, and the ids (little-endian
unsigned 32-bit) are written in ascending ``doc_id`` order: one range of ids per
task and file, whole documents in independent Zstandard frames of about
``FRAME_IDS`` ids. A file ends with a skippable frame that lists its documents
(id, frame, place in the frame, length) and the seek table of the public seekable
format: compressed size, plain size and checksum (low 32 bits of XXH64) of every
frame. A reader fetches the two tables and then only the frames of the documents
asked for, verifying each.

Files are written under a temporary name and renamed, so a repeated or lost task
leaves whole files only; the same rows give the same bytes. Tasks reach the
folder through ``pyarrow.fs``, so any shared file system it knows will do.

Defined results: NULL text is empty, so its document is the end id alone; NULL
``doc_id`` sorts first; rows that repeat a ``doc_id`` are ordered by a hash of
the text, then the text; an empty table makes no file and gives no rows; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import Scratch, documents, shared_folder

FRAME_IDS = 1 << 16
END_ID = 2
SLICE_BYTES = 1 << 20
#: Marks the unit at the start of a text; no byte of UTF-8 equals it.
AT_START = b"\xff"
#: Units that a worker remembers, about 200 bytes each.
MOST_UNITS = 1_500_000
#: Fixed values of the Zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_DOC = np.dtype([("id", "<i8"), ("null", "<u4"), ("frame", "<u4"), ("at", "<u8"), ("n", "<u8")])
_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("sum", "<u4")])
_UNIT = re.compile(rb"[ \n]*[^ \n]+|[ \n]+")
#: White space other than space and newline, in UTF-8; _HINTS holds a part of each.
_ODD_SPACE = re.compile(rb"[\t\x0b-\r\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80"
                        rb"|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_HINTS = (b"\t", b"\r", b"\x0b", b"\x0c", b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2",
          b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80")


#: Marks that words often end in.
_MARKS = b".,;:!?$%&#*()"


class _Units(dict):
    """Ids by unit; what is not there is noted."""

    def __init__(self):
        super().__init__()
        self.wanted: list[bytes] = []

    def __missing__(self, unit: bytes) -> None:
        self.wanted.append(unit)


class Encoder:
    """Ids of texts by a byte-level vocabulary of the tokenizers library.

    Such a vocabulary splits every text where white space follows anything else,
    so a text is the sequence of its units (white space with what follows) and a
    unit is encoded once while the worker remembers it, a word and the marks behind it
    apart where the vocabulary splits them. Texts with other white
    space than space and newline, or with what may be a special string, go through
    the library whole.
    """

    def __init__(self, path: str, most: int = MOST_UNITS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token)  # a byte-level token has a letter per byte
        self.units = _Units()
        self.marks: dict[bytes, bytes] = {}
        self.most = most
        # whether a word and the marks behind it are always split
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        self.splits = all(len(pieces(c + chr(m))) == 2 for c in "a0" for m in _MARKS)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        got = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in got]

    def _encode_units(self, units: list[bytes]) -> list[bytes]:
        """Ids of units, many in one call: led by white space and ending without,
        they stay apart in the joined text, and token sizes tell where each ends."""
        out, joined = [b""] * len(units), []
        for i, u in enumerate(units):
            if u[0] in b" \n" and u[-1] not in b" \n":
                joined.append(i)
            else:
                out[i] = self._encode([u])[0]
        runs = [joined[k:k + 2000] for k in range(0, len(joined), 2000)]
        for run, data in zip(runs, self._encode([b"".join(units[i] for i in r) for r in runs])):
            have = np.cumsum(self.sizes[np.frombuffer(data, dtype="<u4")])
            ends = np.cumsum([len(units[i]) for i in run])
            cuts = np.searchsorted(have, ends)
            if (have[cuts] != ends).any():
                raise ValueError("the vocabulary does not split text before white space")
            at = 0
            for i, cut in zip(run, (4 * (cuts + 1)).tolist()):
                out[i] = data[at:cut]
                at = cut
        return out

    def _learn(self, wanted: list[bytes]) -> None:
        """Remember the ids of units; a word and the marks behind it are encoded apart."""
        units, marks, whole, split = self.units, self.marks, [], []
        for u in dict.fromkeys(wanted):
            stem = u.rstrip(_MARKS) if self.splits else u
            if stem != u and stem[-1:].isalnum():
                split.append((u, stem, u[len(stem):]))
                if stem not in units:
                    whole.append(stem)
            else:
                whole.append(u)
        whole = [*dict.fromkeys(whole)]
        units.update(zip(whole, self._encode_units([
            k[1:] if k[:1] == AT_START else k if k[:1] == b"\n" else b" " + k for k in whole])))
        new = [*dict.fromkeys(m for _, _, m in split if m not in marks)]
        marks.update(zip(new, self._encode(new)))
        units.update((u, units[stem] + marks[mark]) for u, stem, mark in split)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of texts in UTF-8."""
        if len(self.units) > self.most:
            self.units.clear()
            self.marks.clear()
        out, units, late, whole = [b""] * len(texts), self.units, [], []
        units.wanted = []
        for i, text in enumerate(texts):
            if b"<|" in text or (any(h in text for h in _HINTS) and _ODD_SPACE.search(text)):
                whole.append(i)
                continue
            # a unit without its leading space, except at the start of the text
            parts = text.replace(b"\n", b" \n").split(b" ")
            if b"" in parts or b"\n" in parts:
                parts = [AT_START + u for u in _UNIT.findall(text)]
            else:
                parts[0] = AT_START + parts[0]
            found = [*map(units.__getitem__, parts)]
            if None in found:
                late.append((i, parts, found))
            else:
                out[i] = b"".join(found)
        if units.wanted:
            self._learn(units.wanted)
        for i, parts, found in late:
            out[i] = b"".join([units[k] if v is None else v for k, v in zip(parts, found)])
        if whole:
            for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
                out[i] = ids
        return out


_MADE: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _MADE:
        _MADE[path] = Encoder(path)
    return _MADE[path]


class FrameWriter:
    """Writes documents into one file."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS):
        import zstandard

        self.sink, self.frame_bytes = sink, 4 * frame_ids
        self.packer = zstandard.ZstdCompressor(level=1)
        self.entries, self.docs, self.held, self.size = [], [], [], 0
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(self.entries), self.size // 4, len(ids) // 4))
        self.held.append(ids)
        self.size += len(ids)
        self.ids += len(ids) // 4
        if self.size >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        import xxhash

        if self.held:
            plain = b"".join(self.held)
            packed = self.packer.compress(plain)
            self.sink.write(packed)
            self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.held, self.size = [], 0

    def close(self) -> None:
        import xxhash

        self._flush()
        index = np.array(self.docs, dtype=_DOC).tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.entries.append((len(index) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        table = np.array(self.entries, dtype=_ENTRY).tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + 9) + table
                        + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEK_MAGIC))


class FrameReader:
    """Reads the tables of a file at once and its frames as they are asked for."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        at = size - 9 - n * _ENTRY.itemsize
        self.entries = np.frombuffer(self._at(at, n * _ENTRY.itemsize), dtype=_ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        index = self._at(int(self.starts[n - 1]) + 8, int(self.entries["packed"][-1]) - 8)
        self._verify(index, n - 1)
        self.docs = np.frombuffer(index, dtype=_DOC)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def _verify(self, plain: bytes, frame: int) -> None:
        import xxhash

        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.entries["sum"][frame]:
            raise ValueError(f"frame {frame} does not match its checksum")

    def frame(self, i: int) -> bytes:
        entry = self.entries[i]
        plain = self.unpacker.decompress(self._at(int(self.starts[i]), int(entry["packed"])),
                                         max_output_size=max(1, int(entry["plain"])))
        self._verify(plain, i)
        return plain

    def __iter__(self):
        """(doc_id, ids) of every document in order, one frame in memory."""
        last, plain = -1, b""
        for doc_id, null, frame, at, n in self.docs.tolist():
            if frame != last:
                last, plain = frame, self.frame(frame)
            yield (None if null else doc_id), plain[4 * at:4 * (at + n)]

    def read(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents with this id, from their frames alone."""
        own = self.docs[(self.docs["id"] == doc_id) & (self.docs["null"] == 0)]
        return [np.frombuffer(self.frame(int(d["frame"])), dtype="<u4")[
            int(d["at"]):int(d["at"] + d["n"])] for d in own]


def open_file(uri: str, name: str) -> FrameReader:
    system, folder = shared_folder(uri)
    return FrameReader(system.open_input_file(f"{folder}/{name}"))


def _slices(batches):
    """(ids, texts) of at most about SLICE_BYTES bytes, and of one row at least."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _write(uri: str, vocabulary: str, end_id: int, frame_ids: int):
    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        end, writer = struct.pack("<I", end_id), None
        system, folder = shared_folder(uri)
        name = f"part-{task.partitionId():06d}.ids.zst"
        held = f"{folder}/.{name}.{task.taskAttemptId()}"
        for ids, texts in _slices(batches):
            if writer is None:
                system.create_dir(folder, recursive=True)
                writer = FrameWriter(system.open_output_stream(held), frame_ids)
            for i, encoded in zip(ids, encoder(vocabulary).encode(texts)):
                writer.add(i, encoded + end)
        if writer is not None:
            writer.close()
            writer.sink.close()
            system.move(held, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([task.partitionId()], pa.int32()), "file": [name],
                "n_docs": pa.array([len(writer.docs)], pa.int64()),
                "n_ids": pa.array([writer.ids], pa.int64())})
    return run


def write_token_frames(docs: DataFrame, uri: str, vocabulary: str, end_id: int = END_ID,
                       frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write ``docs`` under ``uri``; a row per file in order: part, file, n_docs, n_ids.

    The write runs when the returned rows are computed; keep them in a table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_hash"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("_hash")]
    return (rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
            .select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(_write(uri, vocabulary, end_id, frame_ids),
                        "part int, file string, n_docs long, n_ids long"))


def _read(uri: str):
    def run(batches):
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]

        def rows(cols):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        for batch in batches:
            for start, name in zip(batch.column("start").to_pylist(), batch.column("file").to_pylist()):
                cols = [[] for _ in names]
                for doc_id, ids in open_file(uri, name):
                    for c, v in zip(cols, (doc_id, start, len(ids) // 4, zlib.crc32(ids))):
                        c.append(v)
                    start += len(ids) // 4
                    if len(cols[0]) >= 10_000:
                        yield rows(cols)
                        cols = [[] for _ in names]
                yield rows(cols)
    return run


def read_token_frames(files: DataFrame, uri: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the files."""
    # one row and one task per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    return files.select("part", "file", start.alias("start")).repartitionByRange(
        max(1, files.count()), "part").select(
        "start", "file").mapInArrow(_read(uri), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_frames(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and read the files back."""
    scratch = Scratch(docs.sparkSession, "token-frames")
    uri = f"{scratch.path}/ids"
    files = scratch.save(write_token_frames(docs, uri, vocabulary, end_id), "files")
    return read_token_frames(files, uri)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_frames(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
