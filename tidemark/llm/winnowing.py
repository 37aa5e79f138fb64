"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed; of every window of ``w`` consecutive
hashes the smallest is kept, the rightmost of equal ones, with its position. So
two texts that share ``w + k - 1`` code points in a row share a fingerprint
entry (the match guarantee), and ``positions`` say where.

Everything is built-in functions on one row: a text becomes an array of blocks
of hashes, the window minimum is taken by doubling (minimum of 2, 4, 8 ... hashes),
and hash and position share one number, so that equal hashes are decided by
position. Blocks overlap by a window and bound the arrays, whatever the length of
the text. No row is ever formed per position and nothing is shuffled for it.

Defined results: a NULL text counts as empty; a text shorter than ``k`` is one
gram, a text with fewer than ``w`` grams one window, so every text has at least
one entry and equal texts have equal fingerprints.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import assign_slices, default_slices
from .text import let

BLOCK = 8192
_PLACES = 1 << 16
_HASH_BITS = (1 << 63) - _PLACES


def _once(entries: Column) -> Column:
    """Ascending entries without repeats, which can only be neighbours."""
    return let(
        entries,
        lambda a: F.filter(a, lambda e, i: (i == 0) | (e["position"] != F.get(a, i - 1)["position"])),
    )


@dataclass(frozen=True)
class Winnow:
    """``k`` code points to a gram, ``w`` (a power of two) grams to a window."""

    k: int = 12
    w: int = 16

    def __post_init__(self) -> None:
        if self.k < 1 or self.w < 1 or self.w & (self.w - 1) or self.w > BLOCK:
            raise ValueError("k must be positive and w a power of two")

    @property
    def guarantee(self) -> int:
        return self.w + self.k - 1

    def entries(self, text: Column, start: Column | int = 0) -> Column:
        """Ascending array of (position, hash); positions count from ``start``."""
        k, w = self.k, self.w
        shift = F.lit(start) if isinstance(start, int) else start

        def minima(keys: Column, span: int) -> Column:
            if span == w:
                return F.array_distinct(F.slice(keys, F.lit(1), F.greatest(F.size(keys) - (w - 1), F.lit(1))))
            ahead = F.slice(keys, F.lit(span + 1), F.lit(BLOCK + w))
            return let(F.zip_with(keys, ahead, lambda x, y: F.least(x, y)), lambda m: minima(m, 2 * span))

        def block(codes: Column, at: Column) -> Column:
            grams = F.greatest(F.length(codes) / 4 - (k - 1), F.lit(1)).cast("int")
            count = F.least(grams - at, F.lit(BLOCK + w - 1))
            piece = F.substring(codes, at * 4 + 1, F.lit(4 * (BLOCK + w + k)))
            # The position lowers the key, so of equal hashes the rightmost is smallest.
            key = lambda p: lambda i: F.xxhash64(F.substring(p, i * 4 + 1, F.lit(4 * k))).bitwiseAND(_HASH_BITS) - i
            keys = let(piece, lambda p: F.transform(F.sequence(F.lit(0), count - 1), key(p)))
            picked = let(keys, lambda a: minima(a, 1))
            place = lambda c: F.pmod(-c, F.lit(_PLACES))
            return F.transform(
                picked,
                lambda c: F.struct((place(c) + at + shift).alias("position"), (c + place(c)).alias("hash")),
            )

        def whole(codes: Column) -> Column:
            grams = F.greatest(F.length(codes) / 4 - (k - 1), F.lit(1)).cast("int")
            starts = F.sequence(F.lit(0), F.greatest(grams - w, F.lit(0)), F.lit(BLOCK))
            return _once(F.flatten(F.transform(starts, lambda at: block(codes, at))))

        return let(F.encode(F.coalesce(text, F.lit("")), "UTF-32"), whole)


def hashes(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda e: e["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets that are not both empty."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def hashes_text(entries: Column) -> Column:
    """The hashes in text order, hexadecimal and comma-joined."""
    return F.array_join(F.transform(entries, lambda e: F.hex(e["hash"])), ",")


def positions_text(entries: Column) -> Column:
    """The positions, each but the first less the one before, comma-joined."""
    steps = let(entries, lambda a: F.transform(a, lambda e, i: e["position"] - F.coalesce(F.get(a, i - 1)["position"], F.lit(0))))
    return F.array_join(steps.cast("array<string>"), ",")


def digest(entries: Column) -> Column:
    """The fingerprint as one string: a digest of its hashes in text order."""
    return F.sha2(hashes_text(entries), 256)


def fingerprints(docs: DataFrame, text: str = "text", how: Winnow = Winnow(), name: str = "entries") -> DataFrame:
    """Add the fingerprint of each text; a column of that name is replaced."""
    return docs.withColumn(name, how.entries(F.col(text)))


def _seated(docs: DataFrame, doc_id: str, text: str, slices: int | None):
    """Rows (seat, guest, _doc, _tie, _text) and the window in which the next row is the next document.

    Next is by ascending id (NULL first; equal ids by the hash of the text), and
    the last is followed by the first. The order is cut into slices that meet in
    one task each; the first document of a slice also visits the slice before, as
    a guest behind its last row. So rows are shuffled once, and at most one (id,
    hash) pair per slice is broadcast.
    """
    base = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.withColumn("_tie", F.xxhash64("_text"))
    cut = assign_slices(base, ["_doc", "_tie"], slices)
    firsts = cut.groupBy(F.col("_slice").alias("_here")).agg(F.min(F.struct("_doc", "_tie")).alias("_first"))
    before = F.lag("_here").over(Window.orderBy("_here"))
    firsts = firsts.withColumn("_before", F.coalesce(before, F.max("_here").over(Window.partitionBy())))
    met = cut.join(F.broadcast(firsts), F.col("_slice") == F.col("_here"), "left")
    own = F.struct(F.col("_slice").alias("seat"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("_before").alias("seat"), F.lit(1).alias("guest"))
    is_first = F.struct("_doc", "_tie").eqNullSafe(F.col("_first"))
    seated = met.select("_doc", "_tie", "_text", F.inline(F.when(is_first, F.array(own, visit)).otherwise(F.array(own))))
    return seated, Window.partitionBy("seat").orderBy("guest", "_doc", "_tie")


def compare_edits(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    how: Winnow = Winnow(),
    slices: int | None = None,
) -> DataFrame:
    """Fingerprint each text and its edited text, and compare with both and with the next text.

    The edited text has its last quarter replaced by the start of the next
    document. Windows that lie before the edit belong to both texts and are taken
    once. Returns the id as ``doc_id``, ``text``, ``edited``, ``entries`` and
    ``edited_entries``, ``near_edited`` and ``near_next``; a single document is
    its own next one.
    """
    seated, order = _seated(docs, doc_id, text, slices)
    # A given number of partitions is not coalesced: seats are small in bytes and heavy in work.
    seated = seated.repartition(slices or default_slices(docs), "seat")
    paired = seated.withColumn("_next", F.coalesce(F.lead("_text").over(order), F.lit("")))
    n = F.length("_text")
    keep = n - F.floor(n / 4).cast("int")
    cut = paired.withColumns({"_n": n, "_keep": keep, "_from": F.greatest(keep - (how.guarantee - 1), F.lit(0))})
    kept = F.substring(F.col("_text"), F.lit(1), F.col("_keep"))
    cut = cut.withColumn("_kept", kept).withColumn(
        "_edited", F.concat("_kept", F.substring(F.col("_next"), F.lit(1), F.col("_n") - F.col("_keep")))
    )
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    # Window ``_from`` is the first that reaches the edit; a text too short for that is taken whole.
    rest = lambda t: F.substring(F.col(t), F.col("_from") + 1, F.length(t))
    has_rest = (F.col("_from") == 0) | (F.length("_edited") - F.col("_from") >= how.guarantee)
    parts = cut.withColumns(
        {
            "_head": F.when(F.col("_from") > 0, how.entries(F.col("_kept"))).otherwise(none),
            "_tail": how.entries(rest("_text"), F.col("_from")),
            "_new_tail": F.when(has_rest, how.entries(rest("_edited"), F.col("_from"))).otherwise(none),
        }
    )
    joined = parts.withColumns(
        {
            "_entries": _once(F.concat("_head", "_tail")),
            "_edited_entries": _once(F.concat("_head", "_new_tail")),
        }
    ).select("seat", "guest", "_doc", "_tie", "_text", "_edited", "_entries", "_edited_entries")
    hashed = joined.withColumns({"_h": hashes(F.col("_entries")), "_eh": hashes(F.col("_edited_entries"))})
    beside = hashed.withColumn("_nh", F.lead("_h").over(order)).filter("guest = 0")
    return beside.select(
        F.col("_doc").alias("doc_id"),
        F.col("_text").alias("text"),
        F.col("_edited").alias("edited"),
        F.col("_entries").alias("entries"),
        F.col("_edited_entries").alias("edited_entries"),
        likeness(F.col("_h"), F.col("_eh")).alias("near_edited"),
        likeness(F.col("_h"), F.col("_nh")).alias("near_next"),
    )
