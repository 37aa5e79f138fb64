"""Mix sources to target weights under a time-varying curriculum.

Every source has an integer weight (its share of all words) and a shape: a
piecewise linear curve over training progress 0..1 that says when the share is
spent. The cumulative demand of a source is the integral of its shape; a
document that covers the words ``a..b`` of its source trains where the demand
reaches the middle of that span, and range-sorting by that position gives the
training order.

Only per-source and per-bin sums leave the documents: a source is cut into
hash bins, so a source with a third of all rows is summed in parallel, and no
window ever spans a whole source.

Defined results: a NULL text has no words; NULL is a source of its own, after
all others; documents without words are taken zero times; repeated rows are
documents of their own; equal document ids are ordered by the hash of their text;
an empty table gives an empty mix. Other columns pass through unchanged; a
column of the input that bears the name of an output column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .text import count_words, free_name, row_key

OUTPUT = ("size", "source_size", "target", "taken", "repeats")


@dataclass(frozen=True)
class Share:
    """``weight`` parts of all words, spent over progress as ``shape`` says."""

    weight: int
    shape: Sequence[tuple[float, float]] = ((0.0, 1.0), (1.0, 1.0))

    def __post_init__(self) -> None:
        times = [t for t, _ in self.shape]
        if self.weight <= 0 or times[0] != 0 or times[-1] != 1 or times != sorted(set(times)):
            raise ValueError("a share needs a positive weight and knots from 0 to 1 in ascending order")
        if min(w for _, w in self.shape) < 0 or self.demand()[-1] <= 0:
            raise ValueError("a shape must not be negative and must not be zero everywhere")

    def demand(self) -> list[float]:
        """Integral of the shape up to each knot."""
        sums = [0.0]
        for (t0, w0), (t1, w1) in zip(self.shape, self.shape[1:]):
            sums.append(sums[-1] + (t1 - t0) * (w0 + w1) / 2)
        return sums

    def position(self, share: Column) -> Column:
        """Progress at which the given part (0..1) of the demand is spent."""
        sums = self.demand()
        found = F.lit(None).cast("double")
        for i in reversed(range(len(self.shape) - 1)):
            (t0, w0), (t1, w1) = self.shape[i], self.shape[i + 1]
            rest = share * sums[-1] - sums[i]
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + rest * (2 * slope)))
            step = F.least(F.lit(t1 - t0), F.coalesce(F.try_divide(rest * 2, root + w0), F.lit(0.0)))
            here = F.lit(t0) + step
            found = F.when(share * sums[-1] <= sums[i + 1], here).otherwise(found)
        return found


def source_targets(docs: DataFrame, source: str, size: str, shares: Sequence[Share], cap: int) -> DataFrame:
    """One row per source: weight, size, and the capped target (see ``mix``).

    The windows here run over one row per source.
    """
    sums = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(shares)
    weights = F.array(*(F.lit(s.weight).cast("long") for s in shares))
    everything = Window.partitionBy()
    ranked = (
        sums.withColumn("turn", turn)
        .withColumn("weight", F.get(weights, F.col("turn")))
        .withColumn("limit", F.col("source_size") * cap)
        .withColumn("total", F.sum("source_size").over(everything))
    )
    # Ascending by limit / weight, the capped sources come first. At each source:
    # what the sources before it leave, and the weight that shares it.
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = ranked.withColumn(
        "left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ).withColumn("parts", F.sum("weight").over(onward))
    capped = F.col("limit") * F.col("parts") < F.col("weight") * F.col("left")
    # ``parts`` falls along the order, so the first free source has the largest.
    first_free = F.max(F.when(~capped, F.struct("parts", "left"))).over(everything)
    fair = (F.col("weight") * F.col("free.left")).cast("double") / F.col("free.parts")
    return (
        shared.withColumn("free", first_free)
        .withColumn("target", F.when(capped, F.col("limit").cast("double")).otherwise(fair))
        .select("source", "turn", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    shares: Sequence[Share],
    cap: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bin_digits: int = 3,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add what the mix takes of each document.

    ``size`` words of the text, ``source_size`` and ``target`` words of its
    source, ``taken`` words, and ``repeats``: an array of (pass, words,
    position), one entry for each time the document is trained on.

    Sources take the shares in turn, by code point. A target ends at ``cap``
    times the size of its source and the excess is shared again by weight. A
    target is met to the word: every document is taken as often as the target
    holds the whole source, and the rest goes to the documents that come first by
    the digest of their id; one document per source is taken in part.

    ``bin_digits``: a source is summed in 16 to that power bins. ``keep``: the
    columns to carry, all by default; without the text only numbers are shuffled.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in OUTPUT]
    sized = docs.select(
        F.struct(*kept).alias("kept"),
        F.col(source).alias("origin"),
        count_words(F.col(text)).alias("size"),
        row_key(doc_id).alias("key"),
        F.substring(row_key(doc_id), 1, bin_digits).alias("bin"),
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("tie"),
    )
    goals = source_targets(sized, "origin", "size", shares, cap)
    bins = sized.groupBy(F.col("origin").alias("bin_origin"), F.col("bin").alias("at")).agg(F.sum("size").alias("bin_size"))
    earlier = Window.partitionBy("bin_origin").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("offset", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)))
    bins = bins.join(goals, F.col("bin_origin").eqNullSafe(F.col("source")))
    placed = sized.join(bins, F.col("origin").eqNullSafe(F.col("bin_origin")) & (F.col("bin") == F.col("at")))
    inside = (
        Window.partitionBy("bin_origin", "at").orderBy("key", "id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    )
    goal = F.floor(F.col("target") + 0.5)
    passes = F.coalesce(F.floor(F.try_divide("goal", F.col("source_size"))), F.lit(0)).cast("long")
    part = F.col("goal") - F.col("passes") * F.col("source_size") - F.col("start")
    counted = (
        placed.withColumns({"start": F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)), "goal": goal})
        .withColumn("passes", passes)
        .withColumn("rest", F.greatest(F.lit(0), F.least("size", part)))
    )

    def one(i: Column) -> Column:
        words = F.when(i < F.col("passes"), F.col("size")).otherwise(F.col("rest"))
        middle = i * F.col("source_size") + F.col("start") + words / 2
        share = F.coalesce(F.try_divide(middle, F.col("goal")), F.lit(0.0))
        position = F.lit(None).cast("double")
        for turn, curve in enumerate(shares):
            position = F.when(F.col("turn") == turn, curve.position(share)).otherwise(position)
        return F.struct(i.cast("int").alias("pass"), words.cast("long").alias("words"), position.alias("position"))

    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), one)
    # Apart from ``kept.*``, whose names would hide the ones used in here.
    taken = F.col("passes") * F.col("size") + F.col("rest")
    told = counted.withColumns({"taken": taken, "repeats": F.filter(every, lambda r: r["words"] > 0)})
    return told.select("kept.*", *(F.col(c) for c in OUTPUT))


def training_order(mixed: DataFrame, doc_id: str = "doc_id", untaken: bool = False) -> DataFrame:
    """One row for each time a document is trained on, range-sorted by position.

    ``pass``, ``words`` and ``position`` are added; where ``words`` is below
    ``size``, only that many words are to be read. With ``untaken``, a document
    that is never trained on has one row behind all others, NULL in these three.
    """
    kept = [c for c in mixed.columns if c.lower() not in ("repeats", "pass", "words", "position")]
    times = F.inline_outer("repeats") if untaken else F.inline("repeats")
    return mixed.select(*kept, times).orderBy(F.col("position").asc_nulls_last(), doc_id, "pass")


def taken_in_order(docs: DataFrame, shares: Sequence[Share], doc_id: str = "doc_id", **how) -> DataFrame:
    """One row per document as its training rows add up to, in the order of first training.

    The training order is written to the shared folder and read back, as a sort
    below a sum would be left out. ``taken`` is the sum of the words of a
    document's rows and ``position`` the first of its positions, NULL for documents
    that are never trained on, which come last. Of the other columns ``doc_id``,
    ``size``, ``source_size`` and ``target`` remain; ``how`` as ``mix`` takes it.
    """
    row = free_name(docs, "_row")
    columns = (row, doc_id, "size", "source_size", "target")
    mixed = mix(docs.withColumn(row, F.monotonically_increasing_id()), shares, doc_id=doc_id, keep=(row, doc_id), **how)
    order = settle(training_order(mixed.select(*columns, "repeats"), doc_id, untaken=True), "training-order")
    summed = order.groupBy(*columns).agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("taken"), F.min("position").alias("position")
    )
    return summed.orderBy(F.col("position").asc_nulls_last(), doc_id, row).drop(row)
