"""Near-duplicates by HyperMinHash (operator 8).

1. Every text becomes its set of word shingles (64-bit hashes) and, per bucket,
   a register of 16 bits: the leading-zero count of the bucket's smallest hash and
   the ten bits behind the first one. Each bucket has a hash function of its own,
   so texts of few shingles leave none empty. Texts of equal sets (a 128-bit
   digest of the whole set) form a class; only its smallest document goes on, so a
   group of copies of any size costs one row.
2. Bands of ``ROWS`` registers are the join keys. A link at the threshold misses
   all ``BANDS`` bands with a probability of 2e-8. Documents that share a band key
   are compared by their registers: the share of equal ones, corrected for the
   equality that chance gives registers of that precision, must reach the
   threshold less five standard deviations. Inside a key a spanning forest of
   these comparisons is enough, so there are at most as many rows as members.
3. The components of that forest are the candidate clusters; every link lies
   inside one. In a cluster the full shingle sets are compared, again as a search
   that visits each document once, and only links with
   100 * intersection >= threshold * union are kept. Their components are the
   groups.

Members of a band key, and of a cluster, are dealt to blocks (``BLOCK_ROWS``,
``BLOCK_SHINGLES``), each with a copy of the group's hub, its smallest document, and
the search of a block starts there. What reaches the hub is linked through it, however
many blocks there are, so a group of copies of any size costs its rows once. Only the
members that do not reach it meet all blocks of their group, in tiles of two blocks:
nothing is skipped in large groups, none is gathered whole, and the work beyond one
row per member grows with the members unlike the hub.

Defined results: NULL text and text without words have an empty set and are
linked with nothing; fewer words than a shingle are one shingle; rows that repeat
a ``doc_id`` go with the class of their own set, and classes named by one id are
one node; rows without ``doc_id`` are linked with nothing, lack a component and
are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Scratch, documents, pieces
from visitlens.llm.components import components

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 24, 4
MANTISSA = 10
SIGMAS = 5.0
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 1_000_000
SLICE_SHINGLES = 1 << 17
MOST_WORDS = 200_000
_ONE = np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MOST_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = _WordHashes()
_ODD = np.random.Generator(np.random.PCG64(8)).integers(
    0, 1 << 63, size=2 * (BANDS * ROWS + SHINGLE), dtype=np.uint64) << _ONE | _ONE


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    own = (text or "").encode("utf-8").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, own), np.uint64, len(own))
    n = min(len(w), width)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        h = mixed(h * _ODD[k] + w[k:len(w) - n + 1 + k])
    return np.unique(h)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x buckets) registers of sets that are not empty: exponent and leading
    mantissa bits of the smallest hash, which are its leading-zero count and the
    bits that follow the first one."""
    out = np.zeros((len(sets), BANDS * ROWS), dtype=np.uint16)
    at = 0
    while at < len(sets):
        to, size = at + 1, len(sets[at])
        while to < len(sets) and size + len(sets[to]) <= SLICE_SHINGLES:
            size += len(sets[to])
            to += 1
        x = np.concatenate(sets[at:to])
        starts = np.cumsum([0] + [len(s) for s in sets[at:to - 1]])
        for i in range(BANDS * ROWS):
            least = np.minimum.reduceat(x * _ODD[2 * i] + _ODD[2 * i + 1], starts)
            bits = least.astype(np.float64).view(np.uint64)
            out[at:to, i] = (bits >> np.uint64(52 - MANTISSA)).astype(np.uint16)
        at = to
    return out


def similarity(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard from the share of equal registers of sets of n and m elements, less
    the equality by chance: minima of independent sets fall into one register cell
    with probability n m / (n + m)^2 x mean relative cell width."""
    chance = n * m / (n + m) ** 2 * 2.0 ** -MANTISSA / (2 * np.log(2))
    return (equal - chance) / (1 - chance)


def _sketch(batches):
    for batch in pieces(batches):
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        regs = registers([sets[i] for i in full]) if full else []
        packed: list = [None] * len(sets)
        digests: list = [None] * len(sets)
        for i, r in zip(full, regs):
            packed[i] = r.tobytes()
            digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()),
            "digest": pa.array(digests, pa.binary()), "registers": pa.array(packed, pa.binary())})


def _band_keys(batches):
    for batch in batches:
        regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), dtype="<u8")
        regs = regs.reshape(batch.num_rows, BANDS)
        keys = mixed(regs ^ mixed(np.arange(1, BANDS + 1, dtype=np.uint64)))
        ids = batch.column("doc_id").to_numpy()
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(keys.T.ravel().view(np.int64)), "doc_id": pa.array(np.tile(ids, BANDS))})


def _groups(batches, keys: list[str]):
    """Runs of rows with equal keys in sorted batches, each as a table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.nonzero(new)[0].tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _emitted(forests):
    """Links as (key, a, b); members of a divided group that its hub's search did not
    reach as (key, a, NULL)."""
    def batch(held):
        k, a, b = zip(*held) if held else ((), (), ())
        return pa.RecordBatch.from_pydict({
            "key": pa.array(k, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    held: list = []
    for found in forests:
        held += found
        if len(held) > 20_000:
            yield batch(held)
            held = []
    yield batch(held)


def _search(group: pa.Table, linked) -> list[tuple]:
    """A spanning forest, first of what the hub reaches: ``linked(i, others)`` says
    which others i is linked with."""
    ids = group.column("doc_id").to_numpy()
    key, hub, blocks = (group.column(c)[0].as_py() for c in ("key", "hub", "blocks"))
    out: list[tuple] = []
    queue, rest = np.nonzero(ids == hub)[0].tolist(), np.nonzero(ids != hub)[0]
    reached = False
    while True:
        while queue and len(rest):
            i = queue.pop()
            hit = linked(i, rest)
            for j in rest[hit].tolist():
                out.append((key, int(ids[i]), int(ids[j])))
                queue.append(j)
            rest = rest[~hit]
        if not reached and blocks > 1:
            out += [(key, int(i), None) for i in ids[rest]]
        reached = True
        if len(rest) < 2:
            return out
        queue, rest = [int(rest[0])], rest[1:]


def _similar(percent: int):
    width = BANDS * ROWS
    share = percent / 100
    least = share - SIGMAS * np.sqrt(share * (1 - share) / width)

    def forest(group: pa.Table):
        n = group.column("n").to_numpy().astype(float)
        regs = np.frombuffer(b"".join(group.column("registers").to_pylist()),
                             dtype="<u2").reshape(len(n), width)

        def linked(i, others):
            fits = np.minimum(n[others], n[i]) >= share * np.maximum(n[others], n[i]) - 1e-9
            equal = (regs[others] == regs[i]).mean(1)
            return fits & (similarity(equal, n[others], n[i]) >= least)
        return _search(group, linked)

    return lambda batches: _emitted(map(forest, _groups(batches, ["key", "one", "two"])))


def _confirmed(percent: int):
    def forest(group: pa.Table):
        sets = [shingles(t) for t in group.column("text").to_pylist()]
        n = np.array([len(s) for s in sets])
        every, dense = np.unique(np.concatenate(sets), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(n)])
        mark = np.zeros(len(every), dtype=np.int64)

        def linked(i, others):
            hit = np.zeros(len(others), dtype=bool)
            fits = np.nonzero(100 * np.minimum(n[others], n[i])
                              >= percent * np.maximum(n[others], n[i]))[0]
            mark[dense[at[i]:at[i + 1]]] = 1
            for k in range(0, len(fits), 256):
                some = others[fits[k:k + 256]]
                own = np.concatenate([dense[at[j]:at[j + 1]] for j in some])
                starts = np.cumsum(np.concatenate([[0], n[some][:-1]]))
                common = np.add.reduceat(mark[own], starts)
                hit[fits[k:k + 256]] = 100 * common >= percent * (n[some] + n[i] - common)
            mark[dense[at[i]:at[i + 1]]] = 0
            return hit
        return _search(group, linked)

    return lambda batches: _emitted(map(forest, _groups(batches, ["key", "one", "two"])))


def _by_tile(rows: DataFrame, payload: DataFrame, forest) -> DataFrame:
    return (rows.join(payload, "doc_id").repartition("key", "one", "two")
            .sortWithinPartitions("key", "one", "two")
            .mapInArrow(forest, "key long, a long, b long"))


def _links(members: DataFrame, hubs: DataFrame, payload: DataFrame, forest, limit: int,
           scratch: Scratch, name: str) -> DataFrame:
    """Links (``a, b``) that join what is linked in each group.

    ``members`` are ``key, doc_id, weight``, ``hubs`` are ``key, hub, total`` (of the
    weights) and ``payload`` is what ``forest`` compares, by ``doc_id``.
    """
    def blocks(total: str) -> F.Column:
        return F.greatest(F.lit(1), F.ceil(F.col(total) / limit)).cast("int")

    def all_of(n: str) -> F.Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    dealt = members.join(hubs, "key").withColumn("blocks", blocks("total")).withColumn(
        "own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).drop("total")
    first = dealt.select("key", "doc_id", "hub", "blocks", F.lit(0).alias("one"), F.explode(
        F.when(F.col("doc_id") == F.col("hub"), all_of("blocks")).otherwise(F.array("own"))).alias("two"))
    found = scratch.save(_by_tile(first, payload, forest), f"{name}-first")
    # the members that no block's search from the hub reached, and all blocks of their groups
    apart = found.filter("b IS NULL")
    if apart.isEmpty():   # no second pass over what is compared
        return found.select("a", "b")
    away = scratch.save(apart.select("key", F.col("a").alias("doc_id")).distinct()
                        .join(members, ["key", "doc_id"]), f"{name}-away")
    many = scratch.save(away.groupBy("key").agg(F.sum("weight").alias("away")), f"{name}-many")
    dealt = dealt.join(many.select("key", blocks("away").alias("rows")), "key")
    every = dealt.select("key", "doc_id", "hub", F.explode(all_of("rows")).alias("one"),
                         F.col("own").alias("two"))
    apart = dealt.join(away.select("key", "doc_id").distinct(), ["key", "doc_id"], "left_semi").select(
        "key", "doc_id", "hub", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.col("rows")).cast("int").alias("one"),
        F.explode(all_of("blocks")).alias("two"))
    second = every.unionByName(apart).withColumn("blocks", F.lit(1))
    more = scratch.save(_by_tile(second, payload, forest), f"{name}-second")
    return found.filter("b IS NOT NULL").unionByName(more).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block_rows: int = BLOCK_ROWS,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows = docs.select("doc_id", "text")
    sketched = scratch.save(rows.mapInArrow(
        _sketch, "doc_id long, n long, digest binary, registers binary"), "sketched")
    linkable = sketched.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = scratch.save(linkable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "n", "registers")).alias("r"))
        .select("digest", "r.doc_id", "r.n", "r.registers"), "classes")
    # keys that at least two classes share
    bands = scratch.save(classes.select("doc_id", "registers").mapInArrow(
        _band_keys, "key long, doc_id long"), "bands")
    shared = scratch.save(bands.groupBy("key").agg(
        F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("total")).filter("total > 1"), "shared")
    similar = _links(bands.withColumn("weight", F.lit(1)), shared,
                     classes.select("doc_id", "n", "registers"), _similar(percent), block_rows,
                     scratch, "similar")
    clusters = components(similar, scratch, "clusters")
    # the texts of cluster members, by cluster
    own = scratch.save(
        clusters.join(classes.select("doc_id", "n"), clusters["node"] == F.col("doc_id"))
        .select(F.col("label").alias("key"), "doc_id", F.col("n").alias("weight")), "own")
    sizes = scratch.save(own.groupBy("key").agg(
        F.min("doc_id").alias("hub"), F.sum("weight").alias("total")), "sizes")
    links = _links(own, sizes, rows, _confirmed(percent), block_shingles, scratch, "links")
    labels = components(links, scratch, "groups")
    # rows -> class -> group
    named = scratch.save(
        classes.select("digest", "doc_id").join(
            labels.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left")
        .select("digest", F.coalesce("label", "doc_id").alias("label")), "named")
    out = sketched.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(
        named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
