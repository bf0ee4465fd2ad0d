"""Multipart credential linking (operator 3).

Base findings are labelled assignments, access identifiers and long hex strings;
they always stay. Weak candidates (account identifiers, unlabelled random
strings, endpoints) mean nothing alone: they are reported only where the parts
that complete a credential lie within ``REACH`` code points of them in the same
scope (a block of text between blank lines). An identifier needs a secret, a
secret an identifier, an endpoint both.

Positions come from the pieces between matches: the split of a text at a pattern
and its matches, zipped, give gaps and lengths whose running sum is the place.
Matches are exploded (texts are not), and the interval join of candidates with
the parts around them runs as a sort: in the order of a scope, the furthest end
before a candidate and the nearest start behind it say whether any part's
interval, widened by ``REACH``, meets it. Cost is linear in the matches of a
text; no pairs are made.

Defined results: NULL text is empty and has no spans; a row is a document of its
own, also where ``doc_id`` repeats or is NULL; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import documents

REACH = 200
KINDS = ("assign", "access", "hex", "account", "opaque", "endpoint", "break")
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"
ACCOUNT = r"""(?i)\b(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
OPAQUE = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""\b[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]{3,}"""
BREAK = r"\n[\x20\t\r]*\n"
BASE = 3


def _found(text: Column, kind: str, pattern: str, ok=None, group: int = 0) -> Column:
    """Array of (kind, nth, gap before, length, good) of a pattern's matches."""
    rx = F.lit(pattern)
    matches = F.regexp_extract_all(text, rx, F.lit(0))
    checked = F.regexp_extract_all(text, rx, F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("hit"),
                          checked.alias("value"))
    spans = F.transform(zipped, lambda z, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"),
        F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("len"),
        (ok(z["value"]) if ok else F.lit(True)).alias("good")))
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: s["len"].isNotNull()))


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def _matches(docs: DataFrame) -> DataFrame:
    """One row per match (one row without kind for a document that has none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<kind:int,nth:int,gap:int,len:int,good:boolean>>")
    strong = [_found(text, "assign", ASSIGN, lambda v: F.length(v) >= 6, group=2),
              _found(text, "access", ACCESS, lambda v: F.length(v) >= 20),
              _found(text, "hex", HEX)]
    weak = [_found(text, "account", ACCOUNT), _found(text, "opaque", OPAQUE, _mixed),
            _found(text, "endpoint", ENDPOINT), _found(text, "break", BREAK)]
    # without any identifier no weak candidate can be completed
    linked = text.rlike(ACCESS) | text.rlike(ACCOUNT)
    every = F.concat(*[F.coalesce(a, none) for a in strong],
                     *[F.coalesce(F.when(linked, a), none) for a in weak])
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", every.alias("m"))
    return rows.select("_row", "doc_id", F.explode_outer("m").alias("m")).select(
        "_row", "doc_id", "m.*")


def _near(role: Column, before, behind, reach: int) -> Column:
    ahead = F.col("start") - F.max(F.when(role, F.col("end"))).over(before) <= reach
    after = F.min(F.when(role, F.col("start"))).over(behind) - F.col("end") <= reach
    return F.coalesce(ahead, F.lit(False)) | F.coalesce(after, F.lit(False))


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (start, kind
    number, end, kind) in order, base kinds being the first three."""
    def kind(*names: str) -> Column:
        return F.col("kind").isin([KINDS.index(n) for n in names])

    placed = Window.partitionBy("_row", "kind").orderBy("nth")
    spans = _matches(docs).withColumn(
        "end", F.sum(F.col("gap") + F.col("len")).over(placed)).withColumn(
        "start", F.col("end") - F.col("len")).select(
        # a match that fails its check only holds its document's row
        "_row", "doc_id", F.when(F.col("good"), F.col("kind")).alias("kind"), "start", "end")
    order = Window.partitionBy("_row").orderBy("start", "kind")
    spans = spans.withColumn("scope", F.sum(F.when(kind("break"), 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    up = Window.partitionBy("_row", "scope").orderBy("start", "kind")
    down = Window.partitionBy("_row", "scope").orderBy(F.desc("start"), F.desc("kind"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    behind = down.rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < BASE
    spans = spans.withColumns({
        "id_near": _near(kind("access", "account"), before, behind, reach),
        "secret_near": _near(kind("assign", "hex", "opaque"), before, behind, reach),
        "covered": _near(base, before, behind, -1)})
    report = base | (~F.col("covered") & (
        (kind("account") & F.col("secret_near")) | (kind("opaque") & F.col("id_near"))
        | (kind("endpoint") & F.col("id_near") & F.col("secret_near"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.struct("start", "kind", "end", F.get(names, F.col("kind")).alias("name"))
    return spans.groupBy("_row", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(report, one))).alias("spans")).drop("_row")


def spans_string(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["name"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter(spans, lambda s: s["kind"] < BASE)
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(spans_string(base).cast("binary"), 256).alias("base_sha256"),
        spans_string(spans).alias("spans"))
