"""Token counts by a compiled finite-state transducer (operator 4).

A BPE vocabulary file (byte symbols, end-of-word suffix) is compiled into a
deterministic transducer over the bytes of a word. Each transition carries the
number of tokens it adds, so a count is the sum along a path (a transition that
lets two tokens merge adds none, or less).

What a state knows of the open word is all that its continuation can need: for
each earlier cut from which some token still fits the bytes since, the place in
the token trie, the token ending at the cut and the count up to it. At every
place exactly one token can end a right tokenisation - the one that forms a valid
pair with the token ending where it begins - so states are finite in number and
the next is determined. They are made when first met and kept in the worker up
to ``MAX_STATES``, then made anew; counts do not depend on that.

Long texts are cut into chunks that are mapped in parallel. A chunk has places whose
state is known whatever state comes in. Most are places of rest: white space, digits
(each a piece of its own), the border of a letter and a mark. Inside one long run of
letters they are places whose state follows from the bytes just before: tokens are of
bounded length, so the tokens that may end at a place follow from those that may end at
the places before it, and where one is left for each open cut the state is proven.
So a chunk's state map is: what it has up to the first such place (read in whatever
state comes in), the count from there to the last one, the state there and what it has
behind. Such maps compose associatively, so they are scanned in parallel: those of each
run of ``FAN`` chunks become one map, and these become the text's count. A chunk without
a known place (one letter or mark repeated all through it) passes the state on and so
maps to its own text.

Defined results: NULL text is empty (0 tokens); special strings inside a text
count as one token each, as the library's default has it; each row is a document
of its own, also where ``doc_id`` repeats or is NULL; other columns are not read.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import documents, pieces

MAX_STATES = 200_000
CHUNK_CHARS = 1 << 16
#: Chunk maps that become one; its square of chunks is more than the longest text has.
FAN = 256
LIMIT = 2048
_GAPS = " \t\n\x0b\x0c\r"
#: Letters that normalising leaves apart from what is before them: Latin, Cyrillic,
#: kana, Han, Hangul.
_PLAIN = "A-Za-z\u0410-\u044f\u3041-\u3094\u30a1-\u30f4\u4e00-\u9fa5\uac00-\ud7a3"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"
#: Marks that words often end in.
_ENDS = b".,;:!?$%&#*()"


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


#: Pieces in a string of character classes: letters as "a" (or themselves where a
#: contraction needs them), digits "0", gaps " ", all others "#", but "'" as it is.
_PIECE = re.compile("'(?:[stmd]|re|ve|ll)|[a-z]+|0|[#']+")


class _Classes(dict):
    """Character to class, as the library's own splitter has it; made when met."""

    def __init__(self, pieces):
        super().__init__({ord(c): c for c in "'stmdrevl"})
        self.pieces = pieces

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if not self.pieces(ch):
            got = " "
        elif len(self.pieces(ch + ch)) == 2:
            got = "0"
        else:
            got = "a" if len(self.pieces("a" + ch)) == 1 else "#"
        self[code] = got
        return got


class _Memo(dict):
    """The whole path of a segment as one transition, for up to ``most`` segments."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        got = self[key] = self.make(key)
        return got


class CountTransducer:
    """Counts tokens of texts; build one per worker with :func:`transducer`."""

    def __init__(self, path: str, max_states: int = MAX_STATES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        suffix = model["end_of_word_suffix"]
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.pieces = library.pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.resets = _GAPS + "".join(d for d in "0123456789" if not any(d in t for t in special))
        marks = "".join(m for m in _MARKS if not any(m in t for t in special))
        self.reset_at = re.compile(
            f"[{self.resets}]|(?<=[{_PLAIN}])(?=[{re.escape(marks)}])")
        self.plain = re.compile(f"[{_PLAIN}]+")
        self.special_chars = max(map(len, special), default=0)
        self.lettered = any(self.plain.match(t) for t in special)
        vocab = model["vocab"]
        self.rank = {(vocab[x], vocab[y]): (rank, vocab[x + y])
                     for rank, (x, y) in enumerate(model["merges"])}
        # tokens as symbols: bytes, the last one of a word as 256 + byte
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        single, spelled = {}, {}
        for token, i in vocab.items():
            ends = token.endswith(suffix) and len(token) > len(suffix)
            plain = [letters[c] for c in (token[:-len(suffix)] if ends else token)]
            if ends:
                plain[-1] += 256
            node = 0
            for s in plain:
                if s not in self.trie[node]:
                    self.trie[node][s] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(-1)
                node = self.trie[node][s]
            self.token_at[node] = i
            spelled[i] = (plain, node)
            if len(plain) == 1:
                single[plain[0]] = i
        halves = {}
        for i, (plain, node) in spelled.items():
            *before, last = self._built([single[s] for s in plain])
            if last != [i]:
                self.token_at[node] = -1  # no text is ever tokenised to it
            elif before:
                halves[i] = (self.rank[tuple(before[-1])][0], *before[-1])
        # the parts at a token's left and right edge, with the rank of the merge
        # that takes each into a larger part
        self.left = {i: self._edge(halves, i, 1) for i in vocab.values()}
        self.right = {i: self._edge(halves, i, 2) for i in vocab.values()}
        self.longest = max(len(plain) for plain, _ in spelled.values())
        self.max_states = max_states
        self.classes = _Classes(self.pieces)
        self.segments = _Memo(self._segment, 5 * max_states)
        self.reset()

    def _built(self, ids: list[int]) -> list[list[int]]:
        """The sequences that the merges of ``ids`` pass through."""
        out, rank = [ids], self.rank.get
        while True:
            best, at = None, 0
            for i, pair in enumerate(zip(ids, ids[1:])):
                got = rank(pair)
                if got and (best is None or got < best):
                    best, at = got, i
            if best is None:
                return out
            ids = [*ids[:at], best[1], *ids[at + 2:]]
            out.append(ids)

    @staticmethod
    def _edge(halves: dict, token: int, side: int) -> list[tuple[int, float]]:
        out, until = [], float("inf")
        while token in halves:
            out.append((token, until))
            until, token = halves[token][0], halves[token][side]
        return [*out, (token, until)]

    def reset(self) -> None:
        """Forget all states; they are made again when next met."""
        self.contexts: dict[tuple, int] = {}
        self.items: list[tuple] = []
        self.steps: dict[int, tuple[int, int]] = {}
        self.valid: dict[tuple[int, int], bool] = {}
        self.origin = self._context(((0, -1, 0),))

    def _fits(self, last: int, token: int) -> bool:
        """Whether ``token`` can follow ``last``: no merge across their border comes
        before the merges (by rank, then from the left) that build the two."""
        got = self.valid.get((last, token))
        if got is None:
            rank, none = self.rank, (float("inf"),)
            got = self.valid[last, token] = last < 0 or not any(
                (r := rank.get((x, y), none)[0]) < until_x and r <= until_y and r < none[0]
                for x, until_x in self.right[last] for y, until_y in self.left[token])
        return got

    def _context(self, items: tuple) -> int:
        i = self.contexts.setdefault(items, len(self.items))
        if i == len(self.items):
            self.items.append(items)
        return i

    def _step(self, context: int, symbol: int) -> tuple[int, int]:
        """Make a transition: the context after the symbol, and the tokens it adds."""
        live, ended = [], None
        for node, last, count in self.items[context]:
            child = self.trie[node].get(symbol)
            if child is None:
                continue
            if ended is None and self.token_at[child] >= 0 and self._fits(last, self.token_at[child]):
                ended = (self.token_at[child], count + 1)
            if self.trie[child]:
                live.append((child, last, count))
        token, count = ended
        items = tuple((n, t, c - count) for n, t, c in live) + ((0, token, 0),)
        got = self.steps[context << 9 | symbol] = (
            self._context(items) if symbol < 256 else -1, count)
        return got

    def _word(self, word: str) -> int:
        """Tokens of one piece: the sum along its path."""
        data, context, total, steps = word.encode("utf-8"), self.origin, 0, self.steps
        for symbol in data[:-1]:
            found = steps.get(context << 9 | symbol) or self._step(context, symbol)
            context, k = found
            total += k
        symbol = 256 + data[-1]
        return total + (steps.get(context << 9 | symbol) or self._step(context, symbol))[1]

    def _segment(self, segment: bytes) -> int:
        """Tokens of a run of text between gaps, which starts and ends at rest; a word
        and the marks behind it are remembered apart, as their border is a place of rest."""
        stem = segment.rstrip(_ENDS)
        if stem != segment and stem[-1:].isalnum():
            return self.segments[stem] + self.segments[segment[len(stem):]]
        if len(self.steps) > 4 * self.max_states:
            self.reset()
        text = segment.decode("utf-8")
        return sum(self._word(text[m.start():m.end()])
                   for m in _PIECE.finditer(text.translate(self.classes)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if text.isascii() and "<" not in text:
            return sum(map(self.segments.__getitem__, text.lower().encode().split()))
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(
            sum(map(self.segments.__getitem__, self.normalise(p).encode("utf-8").split()))
            for p in parts if p)

    # -- state maps of chunks -------------------------------------------------

    def _path(self, items: tuple, word: str, closes: bool) -> tuple[tuple, int]:
        """From a state over a piece or, unless it ``closes``, a part of one: the state
        behind it and the sum along the path."""
        if len(self.steps) > 4 * self.max_states:
            self.reset()
        context, total, steps = self._context(items), 0, self.steps
        data = [*word.encode("utf-8")]
        if closes:
            data[-1] += 256
        for symbol in data:
            context, k = steps.get(context << 9 | symbol) or self._step(context, symbol)
            total += k
        return (() if closes else self.items[context]), total

    def _between(self, state: tuple | None, text: str, closes: bool) -> int:
        """Tokens of ``text`` from a known state (None: at rest) to rest or, unless it
        ``closes``, to a place inside its last word."""
        if state is None and closes:
            return self.count(text)
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for i, part in enumerate(parts):
            part = self.normalise(part) if part else ""
            words = [part[m.start():m.end()]
                     for m in _PIECE.finditer(part.translate(self.classes))]
            for k, word in enumerate(words):
                begun = state is not None and i == k == 0
                open_end = not closes and i == len(parts) - 1 and k == len(words) - 1
                total += self._path(state if begun else _REST, word, not open_end)[1]
        return total

    def _known(self, run: str, last: bool) -> tuple[int, tuple] | None:
        """The first (or last) place in a run of plain letters, cut out of a longer one,
        whose state follows from the run alone, and this state."""
        data, deep = run.lower().encode("utf-8"), self.longest
        ending: list[list] = [[] for _ in range(len(data) + 1)]
        alive: list[list] = [[] for _ in range(len(data) + 1)]
        for k in range(len(data)):
            node = 0
            for j in range(k + 1, min(k + deep, len(data)) + 1):
                node = self.trie[node].get(data[j - 1])
                if node is None:
                    break
                if self.token_at[node] >= 0:
                    ending[j].append((k, self.token_at[node]))
                if self.trie[node]:
                    alive[j].append((k, node))
        # what may end at each place; None where a token may begin before the run
        may: list = [None] * min(deep, len(data) + 1)
        for j in range(len(may), len(data) + 1):
            may.append([(k, t) for k, t in ending[j]
                        if may[k] is None or any(self._fits(b, t) for _, b in may[k])])

        def back(j: int) -> dict[int, int]:
            """The proven cuts before a place, each with the tokens between."""
            out = {j: 0}
            while may[j] is not None and len(may[j]) == 1:
                out[may[j][0][0]] = out[j] + 1
                j = may[j][0][0]
            return out

        places, at = [], 0
        for n, c in enumerate(run.lower()):
            if n:
                places.append((n, at))
            at += len(c.encode("utf-8"))
        for n, j in reversed(places) if last else places:
            cuts = [k for k, _ in alive[j]]
            if n < self.special_chars or any(may[k] is None or len(may[k]) != 1 for k in (*cuts, j)):
                continue
            own, items = back(j), []
            for k, node in alive[j]:
                other = back(k)
                shared = max(own.keys() & other.keys(), default=None)
                if shared is None:
                    break
                items.append((node, may[k][0][1], other[shared] - own[shared]))
            else:
                return n, (*items, (0, may[j][0][1], 0))
        return None

    def chunk_map(self, text: str) -> tuple:
        """(up to the first known place, count up to the last one, behind it, the state
        there, whether the first is inside a word). A state is None at rest; what is
        behind is None if the chunk has no known place and passes the state on."""
        first = self.reset_at.search(text)
        if first is not None:
            for start in (max(0, len(text) - 4096), 0):
                behind = max((m.end() for m in self.reset_at.finditer(text, start)), default=0)
                if behind:
                    break
            return text[:first.end()], self.count(text[first.end():behind]), text[behind:], None, False
        edge = 4 * self.longest
        if len(text) > 2 * edge and not self.lettered and self.plain.fullmatch(text):
            begin, end = self._known(text[:edge], False), self._known(text[-edge:], True)
            if begin and end:
                place, behind = begin[0], len(text) - edge + end[0]
                count = self._path(begin[1], text[place:behind].lower(), False)[1]
                return text[:place], count, text[behind:], end[1], True
        return text, 0, None, None, False

    def compose(self, maps: list[tuple]) -> tuple:
        """The map of chunks that follow each other, from theirs."""
        head, count, behind, state, inside = [], 0, None, None, False
        for before, n, after, out, within in maps:
            (head if behind is None else behind).append(before)
            if after is None:
                continue
            if behind is None:
                inside = within
            else:
                count += self._between(state, "".join(behind), not within)
            count, behind, state = count + n, [after], out
        return "".join(head), count, None if behind is None else "".join(behind), state, inside

    def total(self, chunk: tuple) -> int:
        head, count, behind, state, inside = chunk
        return self._between(None, head, not inside) + count + self._between(state, behind or "", True)


#: The state at the start of a word.
_REST = ((0, -1, 0),)
_MAP = "head string, count long, tail string, state string, inside boolean"
_MADE: dict[str, CountTransducer] = {}


def transducer(path: str) -> CountTransducer:
    if path not in _MADE:
        _MADE[path] = CountTransducer(path)
    return _MADE[path]


def _columns(maps: list[tuple]) -> dict:
    heads, counts, tails, states, inside = zip(*maps) if maps else [()] * 5
    return {"head": pa.array(heads, pa.string()), "count": pa.array(counts, pa.int64()),
            "tail": pa.array(tails, pa.string()),
            "state": pa.array([s and json.dumps(s) for s in states], pa.string()),
            "inside": pa.array(inside, pa.bool_())}


def _map(row: dict) -> tuple:
    state = row["state"] and tuple(map(tuple, json.loads(row["state"])))
    return row["head"], row["count"], row["tail"], state, row["inside"]


def _mapped(vocabulary: str, whole: bool):
    """Chunk maps of ``chunk``; with ``whole`` the counts, as each chunk is a text."""
    def run(batches):
        machine = transducer(vocabulary)
        for batch in pieces(batches):
            chunks = batch.column("chunk").to_pylist()
            columns = {n: batch.column(n) for n in batch.schema.names if n != "chunk"}
            yield pa.RecordBatch.from_pydict(columns | (
                {"n_tokens": pa.array(map(machine.count, chunks), pa.int64())} if whole
                else _columns([machine.chunk_map(t) for t in chunks])))
    return run


def _composed(vocabulary: str, last: bool):
    def run(batches):
        machine = transducer(vocabulary)
        for batch in pieces(batches, 1):
            maps = [machine.compose([*map(_map, own)]) for own in batch.column("maps").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "maps"}
            if last:
                yield pa.RecordBatch.from_pydict(columns | {
                    "n_tokens": pa.array(map(machine.total, maps), pa.int64())})
            else:
                yield pa.RecordBatch.from_pydict(columns | _columns(maps))
    return run


def token_counts(docs: DataFrame, vocabulary: str, chunk_chars: int = CHUNK_CHARS,
                 fan: int = FAN) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``.

    Texts of one chunk are counted where they are read. The chunks of longer ones
    are dealt out singly, and their maps (two fragments, a number and a state each) meet
    again by runs of ``fan`` chunks, then by text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    kinds = "doc_id long, n_bytes long, "
    small = (rows.filter(F.length("text") <= chunk_chars)
             .select("doc_id", "n_bytes", F.col("text").alias("chunk"))
             .mapInArrow(_mapped(vocabulary, True), kinds + "n_tokens long"))
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk_chars).cast("int"))
    maps = (rows.filter(F.length("text") > chunk_chars)
            .withColumn("row", F.monotonically_increasing_id())
            .select("row", "doc_id", "n_bytes", F.posexplode(
                F.transform(starts, lambda i: F.substring(
                    F.col("text"), i * chunk_chars + 1, F.lit(chunk_chars)))).alias("nth", "chunk"))
            .repartition("row", "nth")
            .mapInArrow(_mapped(vocabulary, False), f"row long, {kinds}nth int, {_MAP}"))

    def grouped(run):
        return maps.groupBy("row", "doc_id", "n_bytes", run.alias("run")).agg(F.array_sort(
            F.collect_list(F.struct("nth", "head", "count", "tail", "state", "inside"))).alias("maps"))

    maps = grouped(F.floor(F.col("nth") / fan).cast("int")).withColumnRenamed("run", "nth").mapInArrow(
        _composed(vocabulary, False), f"row long, {kinds}nth int, {_MAP}")
    large = grouped(F.lit(0)).select("doc_id", "n_bytes", "maps").mapInArrow(
        _composed(vocabulary, True), f"{kinds}n_tokens long")
    return small.unionByName(large)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
