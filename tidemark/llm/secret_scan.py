"""Find secrets in texts, and link weak candidates that only count together.

Strong kinds are reported wherever they stand: ``assign`` (a name such as
``password`` and its value), ``access`` (an access identifier), ``hex`` (a long
run of lower-case hexadecimal digits). Weak kinds are reported only when the
parts that complete them stand within the same scope:

* ``key_id`` (an identifier shaped like an access key id) needs a secret,
* ``secret`` (40 base64 characters that are not all hexadecimal) needs an identifier,
* ``endpoint`` (a URL) needs both.

Identifiers are ``access`` and ``key_id``; secrets are ``assign`` and
``secret``. Two parts share a scope if they start at most ``scope`` characters
apart. The link is an interval join: positions are cut into buckets as wide as a
scope, the parts of a bucket are reduced to the range they span, and a candidate
meets the ranges of three buckets. So no pairs of parts are ever formed.

Everything is built-in functions. Positions are code points, ends exclusive.

Defined results: NULL and empty texts have no spans; repeated rows get the same
spans each; texts are read whole; an empty table gives an empty result; spans of
different kinds may overlap. Other columns pass through; a column of the input
named ``base`` or ``spans`` is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle


@dataclass(frozen=True)
class Kind:
    """A pattern; ``value``: the group whose length must reach ``least``."""

    name: str
    pattern: str
    value: int = 0
    least: int = 0
    strong: bool = True
    role: str = ""


KINDS = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2,
        least=12,
        role="secret",
    ),
    Kind("access", r"AKIA[A-Z0-9]{14,}", role="id"),
    Kind("hex", r"[0-9a-f]{16,}"),
    Kind("key_id", r"(?<![A-Z0-9])(?!AKIA)A[A-Z]{3}[A-Z0-9]{16}(?![A-Z0-9])", strong=False, role="id"),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9/+])(?![0-9a-f]{40})[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+])",
        strong=False,
        role="secret",
    ),
    Kind("endpoint", r"https?://[A-Za-z0-9./:_-]+", strong=False),
)
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
KEY = ["_doc", "_digest"]


def _lengths(text: Column, kind: Kind, rank: int) -> Column:
    """The text as (gap before a match, match, its value) lengths, NULL without a match."""
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.value)) if kind.value else matches
    gaps = F.split(text, kind.pattern, -1)
    pieces = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("g"), matches.alias("m"), values.alias("v")),
        lambda z: F.struct(
            F.length(z["g"]).alias("gap"), F.length(z["m"]).alias("match"), F.length(z["v"]).alias("value")
        ),
    )
    found = F.struct(F.lit(rank).alias("rank"), pieces.alias("pieces"))
    return F.when(text.rlike(kind.pattern), found)


def parts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every match of every kind: (_doc, _digest, rank, start, end).

    The start is the sum of the lengths before it, taken by a window over the
    matches of one text and kind; texts themselves are not shuffled.
    """
    whole = F.col("_text")
    base = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = F.array_compact(F.array(*(_lengths(whole, kind, i) for i, kind in enumerate(KINDS))))
    rows = base.select("_doc", F.md5(whole).alias("_digest"), F.explode(found).alias("k"))
    rows = rows.select(*KEY, "k.rank", "k.pieces").dropDuplicates([*KEY, "rank"])
    each = rows.select(*KEY, "rank", F.posexplode("pieces").alias("i", "p"))
    before = Window.partitionBy(*KEY, "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("p.gap") + F.col("p.match")).over(before)
    least = F.get(F.array(*(F.lit(k.least) for k in KINDS)), F.col("rank"))
    return (
        each.withColumn("end", end.cast("int"))
        .filter(F.col("p.value") >= least)
        .select(*KEY, "rank", (F.col("end") - F.col("p.match")).alias("start"), "end")
    )


def _ranks(test) -> list[int]:
    return [i for i, kind in enumerate(KINDS) if test(kind)]


def linked(found: DataFrame, scope: int) -> DataFrame:
    """The weak parts that parts of the other roles complete within a scope."""
    bucket = F.floor(F.col("start") / scope)
    is_id = F.col("rank").isin(_ranks(lambda k: k.role == "id"))
    is_secret = F.col("rank").isin(_ranks(lambda k: k.role == "secret"))
    ranges = (
        found.filter(is_id | is_secret)
        .groupBy(*KEY, bucket.alias("bucket"))
        .agg(
            F.min(F.when(is_id, F.col("start"))).alias("id_from"),
            F.max(F.when(is_id, F.col("start"))).alias("id_to"),
            F.min(F.when(is_secret, F.col("start"))).alias("secret_from"),
            F.max(F.when(is_secret, F.col("start"))).alias("secret_to"),
        )
        .withColumn("bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)))
        .withColumnsRenamed({k: f"{k}_r" for k in KEY})
        .withColumnRenamed("bucket", "bucket_r")
    )
    weak = found.filter(F.col("rank").isin(_ranks(lambda k: not k.strong))).withColumn("bucket", bucket)
    same = F.col("bucket") == F.col("bucket_r")
    for k in KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_r"))

    def near(role: str) -> Column:
        low, high = F.col(f"{role}_from"), F.col(f"{role}_to")
        return F.bool_or(F.coalesce((low <= F.col("start") + scope) & (high >= F.col("start") - scope), F.lit(False)))

    met = weak.join(ranges, same).groupBy(*KEY, "rank", "start", "end").agg(near("id").alias("i"), near("secret").alias("s"))
    name = F.get(F.array(*(F.lit(k.name) for k in KINDS)), F.col("rank"))
    needs_id, needs_secret = name.isin("secret", "endpoint"), name.isin("key_id", "endpoint")
    return met.filter((F.col("i") | ~needs_id) & (F.col("s") | ~needs_secret)).select(*KEY, "rank", "start", "end")


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = 256, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``base`` (strong spans) and ``spans`` (strong and linked weak spans),
    arrays of (start, rank, end, kind) by start, then kind as listed. ``keep``: the
    columns to carry, all by default; without the text no text is shuffled."""
    found = settle(parts(docs, doc_id, text), "parts")
    strong = found.filter(F.col("rank").isin(_ranks(lambda k: k.strong)))
    reported = strong.unionByName(linked(found, scope))
    names = F.array(*(F.lit(k.name) for k in KINDS))
    span = F.struct("start", "rank", "end", F.get(names, F.col("rank")).alias("kind"))
    per_doc = reported.groupBy(*KEY).agg(F.array_sort(F.collect_list(span)).alias("_all"))
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("base", "spans")]
    keyed = docs.select(
        F.struct(*kept).alias("_kept"),
        F.col(doc_id).alias("_doc_key"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_text_key"),
    )
    same = F.col("_doc_key").eqNullSafe(F.col("_doc")) & (F.col("_text_key") == F.col("_digest"))
    every = F.coalesce(F.col("_all"), F.array().cast(SPAN))
    n_strong = len(_ranks(lambda k: k.strong))
    joined = keyed.join(per_doc, same, "left").withColumn("spans", every)
    told = joined.withColumn("base", F.filter("spans", lambda s: s["rank"] < n_strong))
    # Apart from ``_kept.*``, whose names would hide the ones used above.
    return told.select("_kept.*", "base", "spans")


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
