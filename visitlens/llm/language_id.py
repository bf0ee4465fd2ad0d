"""Language identification by character language models (operator 1).

One interpolated Kneser-Ney model of order ``ORDER`` per language: the highest
order uses counts, lower orders the number of distinct characters seen before a
gram, each level is discounted and the mass saved weights the next lower level
down to a uniform one. Counting runs over all labelled rows of the fitting fold, of
every language; all grams stay, and the model is finished from them in Spark. It
lies in the shared folder as arrays of grams, sorted and cut by range, with the
log-probabilities of the languages that have a gram, and grows with the input. Tasks
look the distinct grams of a slice of texts up in the ranges they fall into and hold
a bounded part of the ranges; the driver holds one row per language and range.

Texts are read whole as lower-case letters with all else as one space. A text
gets the language of the lowest cross-entropy per character. ``score`` is the
probability of that language after scaling by a temperature that minimises the
log loss on a fold of its own, which neither counts grams nor is held out. That
fold also gives each language's mean and spread of cross-entropy (the spread as a
part between texts and a part that shrinks with length); a text is rejected if
its cross-entropy lies ``REJECT_Z`` such spreads above the mean of its best
language and nearer to that of random letters of that language's own alphabet than
to that mean, so that only text unlike every language goes, not noisy or mixed text,
whatever scripts the other languages have.

Folds by crc32(doc_id as text) mod 3: 0 counts, 2 calibrates, 1 is held out. A
language with rows in one of the first two only gives the other those of one doc_id,
or uses them for both if it has no other.

Defined results: NULL text or text without a letter is ``und`` with score 0 and
rejected; with no labelled rows at all every text is; equal cross-entropies give
the language first in code-point order; a NULL ``doc_id`` is read as empty text
for the fold. Rows that repeat count as often as they appear.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.common import Scratch, documents, pieces, shared_folder
from visitlens.operators.joins import broadcast_if_bounded

ORDER = 4
REJECT_Z = 8.0
SLICE = 1 << 19
LANGUAGES_AT_ONCE = 16
HELD = 128 << 20
RARE = 10_000
RANGE_ROWS = 200_000
#: Tables of one row per language are broadcast up to this number of rows.
FEW = 100_000
TEMPERATURES = tuple(2.0 ** (k / 2) for k in range(-16, 5))
SPACE = 32
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point: a 16-bit number of its own if it is a letter, else a space.

    Letters up to U+FFFF are their own numbers. Those beyond take the numbers of the
    code points up to U+FFFF that are no letters, in order and from the first again when
    these run out (they are about 16,000): letters that share one lie that far apart, so
    never in one script's block of fewer letters.
    """
    if not _LETTERS:
        table = np.full(0x110000, SPACE, dtype=np.uint16)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        low = np.flatnonzero(letter[:0x10000])
        table[low] = low
        free = np.setdiff1d(np.arange(1, 0x10000), np.append(low, SPACE))
        high = np.arange(0x10000, 0x110000)
        table[high] = np.where(letter[high], free[(high - 0x10000) % len(free)], SPACE)
        _LETTERS.append(table)
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed grams of all texts, 16 bits a character, newest lowest; and where
    each text starts. Every text is led by spaces and ends with one."""
    pad = " " * (ORDER - 1)
    parts = [(pad + t + " ").lower() for t in texts]
    cp = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    chars = _letters()[cp].astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    keep = np.ones(len(chars), dtype=bool)
    keep[1:] = (chars[1:] != SPACE) | (chars[:-1] != SPACE)
    for k in range(ORDER - 1):
        keep[first + k] = True
    # what lies in front of a text's first character is no gram of its own
    chars, starts = chars[keep], np.concatenate([[0], np.cumsum(keep)])[first]
    packed = chars.copy()
    for k in range(1, ORDER):
        packed[k:] |= chars[:-k] << np.uint64(16 * k)
    own = np.ones(len(chars), dtype=bool)
    for k in range(ORDER - 1):
        own[starts + k] = False
    return packed[own], starts - (ORDER - 1) * np.arange(len(starts))


def slices(texts: list[str]):
    """Runs of texts of about SLICE characters; (from, to) indexes."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


class Table:
    """The fitted model as it lies in the shared folder: one Parquet file per range of
    packed grams and order, sorted by gram, with the values of each language that has
    the gram. A task opens the files that its texts' grams fall into and holds up to
    ``HELD`` bytes of them, so neither the driver nor a task holds the whole model,
    whatever its size; grams sorted as packed keep one script's grams in few files.
    """

    def __init__(self, uri: str, languages: list[str], floor: float, random: list[float],
                 ranges: dict[str, tuple]):
        self.uri, self.languages, self.floor = uri, languages, floor
        self.random = random    # nats of a random character of each language's own alphabet
        self.ranges = ranges    # by table and order: first grams, file names

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _file(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = self.__dict__.setdefault("_held", OrderedDict())
        if name in held:
            held.move_to_end(name)
            return held[name]
        system, folder = shared_folder(self.uri)
        with system.open_input_file(f"{folder}/{name}") as f:
            t = pq.read_table(f, columns=["gram", "lang", "value"])
        got = (t.column("gram").to_numpy(), t.column("lang").to_numpy(), t.column("value").to_numpy())
        held[name] = got
        while len(held) > 1 and sum(x.nbytes for g in held.values() for x in g) > HELD:
            held.popitem(last=False)
        return got

    def spread(self, kind: str, grams: np.ndarray, into: np.ndarray, languages: slice) -> None:
        """Write the values of sorted ``grams`` where languages have them."""
        firsts, names = self.ranges[kind]
        # files whose range may hold one of the grams; a gram's rows can cross files
        low = np.searchsorted(grams, firsts, "left")
        high = np.append(np.searchsorted(grams, firsts[1:], "right"), len(grams))
        for name, a, b in zip(names, low, high):
            if a == b:
                continue
            own, lang, value = self._file(name)
            at = np.searchsorted(own, grams[a:b], "left")
            n = np.searchsorted(own, grams[a:b], "right") - at
            row = np.repeat(np.arange(a, b), n)
            src = np.repeat(at, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            col = lang[src]
            fits = (col >= languages.start) & (col < languages.stop)
            into[row[fits], col[fits] - languages.start] = value[src[fits]]

    def logp(self, grams: np.ndarray, languages: slice, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last character of sorted distinct grams, by language."""
        if order == 0:
            return np.full((len(grams), languages.stop - languages.start), self.floor)
        low, at = np.unique(grams & np.int64((1 << (16 * (order - 1))) - 1), return_inverse=True)
        out = self.logp(low, languages, order - 1)[at]
        contexts, at = np.unique((grams.view(np.uint64) >> np.uint64(16)).view(np.int64),
                                 return_inverse=True)
        weight = np.zeros((len(contexts), out.shape[1]))
        self.spread(f"back{order}", contexts, weight, languages)
        out += weight[at]
        self.spread(f"gram{order}", grams, out, languages)
        return out


def entropies(model: Table, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts x languages) nats per character, characters, mean square of the nats -
    all slices of bounded size, long texts and many languages included."""
    many = len(model.languages)
    sums = np.zeros((len(texts), many))
    squares, chars = np.zeros_like(sums), np.zeros(len(texts))
    pieces = [(i, t[k:k + SLICE]) for i, t in enumerate(texts) for k in range(0, len(t), SLICE)]
    for a, b in slices([p for _, p in pieces]):
        packed, starts = grams([p for _, p in pieces[a:b]])
        which = np.array([i for i, _ in pieces[a:b]])
        own, at = np.unique(packed.view(np.int64), return_inverse=True)
        for first in range(0, many, LANGUAGES_AT_ONCE):
            some = slice(first, min(many, first + LANGUAGES_AT_ONCE))
            logs = -model.logp(own, some).astype(np.float32)[at]
            np.add.at(sums, (which, some), np.add.reduceat(logs, starts, dtype=np.float64))
            np.add.at(squares, (which, some), np.add.reduceat(logs * logs, starts, dtype=np.float64))
        np.add.at(chars, which, np.diff(np.append(starts, len(packed))))
    chars = np.maximum(chars, 1)
    return sums / chars[:, None], chars, squares / chars[:, None]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fold(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3


def _counter(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def run(batches):
        held: dict[int, list] = {i: [] for i in range(len(languages))}

        def merged(i):
            keys = np.concatenate([k for k, _ in held[i]])
            counts = np.concatenate([c for _, c in held[i]])
            uniq, at = np.unique(keys, return_inverse=True)
            return uniq, np.bincount(at, counts).astype(np.int64)

        def rows(i):
            keys, counts = merged(i)
            held[i] = []
            return pa.RecordBatch.from_pydict({
                "lang": pa.array(np.full(len(keys), i), pa.int32()),
                "gram": pa.array(keys.view(np.int64)), "n": pa.array(counts)})

        for batch in pieces(batches):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            by: dict[int, list[str]] = {}
            for t, x in zip(texts, langs):
                by.setdefault(number[x], []).append(t)
            for i, own in by.items():
                for a, b in slices(own):
                    keys, counts = np.unique(grams(own[a:b])[0], return_counts=True)
                    held[i].append((keys, counts.astype(np.int64)))
                    if len(held[i]) > 16:
                        held[i] = [merged(i)]
                        if len(held[i][0][0]) > 500_000:
                            yield rows(i)
        for i in held:
            if held[i]:
                yield rows(i)
    return run


def _scorer(shared, keep: list[str]):
    def run(batches):
        model = shared.value
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            h, chars, squares = entropies(model, texts)
            best = h.argmin(1)
            row = np.arange(len(h))
            out = {"_h": pa.array(list(h), pa.list_(pa.float64())), "_chars": pa.array(chars),
                   "_spread": pa.array(squares[row, best] - h[row, best] ** 2),
                   "_letters": pa.array([has_letter(t) for t in texts], pa.bool_())}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | out)
    return run


_SCORES = "_h array<double>, _chars double, _spread double, _letters boolean"


def _scored(rows: DataFrame, shared, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``rows``, and the scores of ``text``."""
    kept = T.StructType([rows.schema[c] for c in keep] + T.StructType.fromDDL(_SCORES).fields)
    return rows.mapInArrow(_scorer(shared, keep), kept)


def _probability(h: Column, temperature: float) -> Column:
    """Of the best language, from cross-entropies."""
    least = F.array_min(h)
    return 1 / F.aggregate(h, F.lit(0.0), lambda a, x: a + F.exp((least - x) / temperature))


@dataclass
class Calibration:
    temperature: float
    mean: list[float]
    between: list[float]
    within: list[float]


def calibrate(scored: DataFrame, languages: list[str]) -> Calibration:
    """From rows of labelled texts with their cross-entropies; aggregates only."""
    number = F.create_map(*[x for i, n in enumerate(languages) for x in (F.lit(n), F.lit(i))])
    rows = scored.filter("_letters").withColumn("own", F.get("_h", number[F.col("lang")]))
    least = F.array_min("_h")
    losses = [F.avg((F.col("own") - least) / t - F.log(_probability(F.col("_h"), t)))
              .alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]
    row = rows.agg(*losses).first()
    temperature = min(zip((row[f"t{k}"] if row[f"t{k}"] is not None else 9e9
                           for k in range(len(TEMPERATURES))), TEMPERATURES))[1]
    by = {r["lang"]: r for r in rows.groupBy("lang").agg(
        F.avg("own").alias("mean"), F.var_pop("own").alias("between"),
        F.avg("_spread").alias("within")).collect()}  # one row per language
    none = {"mean": float(np.log(100)), "between": 1.0, "within": 1.0}
    own = [by.get(x, none) for x in languages]
    return Calibration(temperature, *[[r[c] for r in own] for c in ("mean", "between", "within")])


@dataclass
class LanguageId:
    model: Table
    calibration: Calibration


def _levels(counts: DataFrame, scratch: Scratch) -> dict[int, DataFrame]:
    """``lang, gram, n`` of each order from those of the highest: lower orders count
    the distinct characters in front of a gram."""
    out = {ORDER: scratch.save(counts, f"n{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))
        out[order] = scratch.save(out[order + 1].groupBy("lang", low.alias("gram")).agg(
            F.count(F.lit(1)).alias("n")), f"n{order}")
    return out


def fit(languages: list[str], counts: DataFrame) -> Table:
    """Kneser-Ney from rows (language number, gram, count) of the highest order, each
    step a grouping or a join of tables in the shared folder."""
    scratch = Scratch(counts.sparkSession, "language-model")
    levels = _levels(counts, scratch)
    vocabulary = levels[1].agg(F.count_distinct("gram")).first()[0]
    floor = -float(np.log(max(1, vocabulary) + 1))
    ranges, lower = {}, None
    for order in range(1, ORDER + 1):
        n, context = F.col("n"), F.shiftrightunsigned("gram", 16)
        ones, twos = F.count_if(n == 1), F.count_if(n == 2)
        discounts = levels[order].groupBy("lang").agg(F.greatest(F.lit(0.1), F.least(
            F.lit(0.9), ones / F.greatest(ones + 2 * twos, F.lit(1)))).alias("d"))
        # by language and context, with the discount of the language (one row each)
        back = scratch.save(
            levels[order].groupBy("lang", context.alias("context")).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("seen"))
            .join(broadcast_if_bounded(discounts, FEW), "lang")
            .select("lang", "context", "total", "d", (F.col("d") * F.col("seen") / F.col("total")).alias("w")),
            f"contexts{order}")
        rows = levels[order].withColumn("context", context).join(back, ["lang", "context"])
        own = F.greatest(n - F.col("d"), F.lit(0.0)) / F.col("total")
        if order == 1:
            p = own + F.col("w") * F.lit(float(np.exp(floor)))
        else:
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(
                F.lit((1 << (16 * (order - 1))) - 1))).join(
                lower.select("lang", F.col("gram").alias("low"), F.col("p").alias("q")), ["lang", "low"])
            p = own + F.col("w") * F.col("q")
        ranges[f"back{order}"] = _sorted_files(
            back.select(F.col("context").alias("gram"), "lang", F.log("w").cast("float").alias("value")),
            scratch, f"back{order}")
        lower = scratch.save(rows.select("lang", "gram", p.alias("p")), f"p{order}")
        ranges[f"gram{order}"] = _sorted_files(
            lower.select("gram", "lang", F.log("p").cast("float").alias("value")), scratch, f"gram{order}")
    return Table(scratch.path, languages, floor, _random_letters(levels[ORDER], len(languages)), ranges)


def _random_letters(counts: DataFrame, many: int) -> list[float]:
    """By language, the nats of a character drawn at random from its own alphabet: the
    characters that are at least one in ``RARE`` of its text."""
    chars = counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("char")).agg(
        F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = chars.join(broadcast_if_bounded(totals, FEW), "lang").groupBy("lang").agg(
        F.count_if(F.col("n") * RARE >= F.col("total")).alias("size"))
    by = {r["lang"]: r["size"] for r in sizes.collect()}  # one row per language
    return [float(np.log(by.get(i, 0) + 1)) for i in range(many)]


def _sorted_files(rows: DataFrame, scratch: Scratch, name: str) -> tuple[np.ndarray, list[str]]:
    """Saved in files of one range of grams each: their first grams and names."""
    many = max(1, -(-rows.count() // RANGE_ROWS))
    saved = scratch.save(rows.repartitionByRange(many, "gram", "lang")
                         .sortWithinPartitions("gram", "lang"), name)
    # one row per file
    files = sorted((r["first"], r["file"]) for r in saved.groupBy(
        F.col("_metadata.file_name").alias("file")).agg(F.min("gram").alias("first")).collect())
    return np.array([f for f, _ in files], np.int64), [f"{name}/{f}" for _, f in files]


def _dealt(rows: DataFrame, fitting: int, calibrating: int,
           scratch: Scratch) -> tuple[DataFrame, list[str]]:
    """``lang, text, fits, calibrates`` of the rows of two folds, and the languages.
    A language that has rows in one of them only gives the other its rows of the
    largest key; one whose rows have one key uses them for both."""
    by = scratch.save(rows.groupBy("lang").agg(
        F.count_if(F.col("fold") == fitting).alias("a"), F.count_if(F.col("fold") == calibrating).alias("b"),
        F.min("key").alias("least"), F.max("key").alias("most")), "languages")
    of = by.select("lang", (F.col("a") == 0).alias("no_a"), (F.col("b") == 0).alias("no_b"),
                   (F.col("least") == F.col("most")).alias("alone"), "most")
    short = F.expr("no_a OR no_b")
    top, fits = F.expr("key = most"), F.col("fold") == fitting
    # one row per language
    dealt = rows.join(broadcast_if_bounded(of, FEW), "lang").select(
        "lang", "text",
        F.when(~short, fits).otherwise(F.col("alone") | (F.col("no_a") == top)).alias("fits"),
        F.when(~short, ~fits).otherwise(F.col("alone") | (F.col("no_a") != top)).alias("calibrates"))
    return dealt, sorted(r["lang"] for r in by.select("lang").collect())


def train(docs: DataFrame, fitting: int = 0, calibrating: int = 2) -> LanguageId | None:
    """Fit and calibrate on the labelled rows of two folds; None without any."""
    spark = docs.sparkSession
    rows = (docs.filter("lang IS NOT NULL AND text IS NOT NULL")
            .select("lang", "text", fold(docs["doc_id"]).alias("fold"), F.xxhash64("doc_id").alias("key")))
    rows = rows.filter(F.col("fold").isin(fitting, calibrating) & F.col("text").rlike("\\p{L}"))
    scratch = Scratch(spark, "language-id")
    rows, languages = _dealt(rows, fitting, calibrating, scratch)
    if not languages:
        return None
    fitted = rows.filter("fits").select("lang", "text")
    counts = (fitted.mapInArrow(_counter(languages), "lang int, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    model = fit(languages, counts)
    scored = scratch.save(_scored(
        rows.filter("calibrates").select("lang", "text"), spark.sparkContext.broadcast(model), ["lang"]),
        "scored")
    return LanguageId(model, calibrate(scored, languages))


def judged(docs: DataFrame, trained: LanguageId | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, and ``_lang_pred, _score, _rejected``
    from its ``text``. Rows stay where they are, so no key is needed to tell them apart."""
    if trained is None:
        return docs.select(*keep, F.lit("und").alias("_lang_pred"), F.lit(0.0).alias("_score"),
                           F.lit(True).alias("_rejected"))
    c = trained.calibration
    shared = docs.sparkSession.sparkContext.broadcast(trained.model)
    scored = _scored(docs, shared, keep)
    best = (F.array_position("_h", F.array_min("_h")) - 1).cast("int")

    def of(values: list[float]) -> Column:
        return F.get(F.array(*[F.lit(float(v)) for v in values]), best)

    spread = F.sqrt(of(c.between) + of(c.within) / F.col("_chars"))
    strange = F.array_min("_h") > F.greatest(
        of(c.mean) + REJECT_Z * F.greatest(spread, F.lit(1e-6)),
        (of(c.mean) + of(trained.model.random)) / 2)
    names = F.array(*[F.lit(x) for x in trained.model.languages])
    letters = F.col("_letters")
    return scored.select(
        *keep, F.when(letters, F.get(names, best)).otherwise("und").alias("_lang_pred"),
        F.when(letters, _probability(F.col("_h"), c.temperature)).otherwise(0.0).alias("_score"),
        (~letters | strange).alias("_rejected"))


def predict(docs: DataFrame, trained: LanguageId | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row."""
    held = (fold(docs["doc_id"]) == 1).alias("held_out")
    out = judged(docs.select("doc_id", held, "text"), trained, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", *[F.col(f"_{c}").alias(c)
                                              for c in ("lang_pred", "score", "rejected")])


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are."""
    # by place, so that no column of docs can have a name that is used here
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    kept = judged(docs.toDF(*names), train(docs), names).filter("NOT _rejected")
    return kept.select(*names).toDF(*docs.columns)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
