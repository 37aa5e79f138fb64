"""Find test items in training documents through a positional inverted index.

1. The words of all test items are counted over the whole corpus.
2. Every window of ``n`` consecutive words of an item (an item with fewer words is
   one window) names its two rarest words as anchors.
3. The postings of the anchor words - word, document, position, and the ``n - 1``
   words on either side - are stored; postings no query would read are not.
4. The two posting lists of a window are shifted by the words' offsets and
   intersected. Equal starts whose neighbourhood holds the whole window are exact
   phrase matches; starts at most ``slack`` words apart are proximity matches.

Words are 64-bit hashes; a match compares all words of a window. Corpus texts are
read twice and never shuffled; which words are looked for is passed to the tasks
as a bitmap of fixed size, whose false hits vanish in the join.

Defined results: NULL and empty texts have no words and match nothing; items
without words have no windows; repeated rows get the same matches each; equal
windows of several items count for each of them; without items or documents
there are no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..session import scratch, settle
from .words import ALNUM, blocks, few_rows, marked, slot_bits

KEY = ["_doc", "_row"]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(whole).alias("_row"), whole.cast("binary").alias("_text"))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", n: int = 10) -> DataFrame:
    """(item, words) - one row per window of each item, words as hashes."""
    rows = items.select(F.col(item_id).alias("item"), F.col(text).cast("binary").alias("_text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            for block in blocks(batch["_text"].to_pylist(), ALNUM):
                part = batch.slice(block.first, len(block.ends))
                words = pa.ListArray.from_arrays(
                    pa.array(np.append(0, block.ends), pa.int32()), pa.array(block.hashes.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([part["item"], words], ["item", "terms"])

    schema = StructType([rows.schema["item"], StructField("terms", ArrayType(LongType()))])
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - (n - 1), F.lit(1)))
    return (
        rows.mapInArrow(terms, schema)
        .filter(F.size("terms") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("terms", i, F.lit(n)))).alias("words"))
        .distinct()
    )


def _count(bits) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            found = [b.hashes[marked(b.hashes, bits.value)] for b in blocks(batch["_text"].to_pylist(), ALNUM)]
            if found:
                words, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"]
                )

    return run


def _index(bits, n: int):
    """One row per document: its number of words and the postings that are looked for."""
    around = np.arange(-(n - 1), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            for block in blocks(batch["_text"].to_pylist(), ALNUM):
                hashes, starts = block.hashes, block.starts
                hit = np.flatnonzero(marked(hashes, bits.value))
                owner = np.searchsorted(block.ends, hit, side="right")
                near = hit[:, None] + around
                inside = (near >= starts[owner][:, None]) & (near < block.ends[owner][:, None])
                context = np.zeros(near.shape, dtype=np.int64)
                context[inside] = hashes.view(np.int64)[near[inside]]
                width = 2 * n - 1
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(hit) * width + 1, width), pa.int32()), pa.array(context.ravel())
                )
                postings = pa.StructArray.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)[hit]),
                        pa.array((hit - starts[owner]).astype(np.int64)),
                        lists,
                    ],
                    ["word", "at", "around"],
                )
                offsets = pa.array(np.searchsorted(hit, np.append(0, block.ends)), pa.int32())
                part = batch.slice(block.first, len(block.ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["_doc"],
                        part["_row"],
                        pa.array(block.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, postings),
                    ],
                    ["_doc", "_row", "n_words", "postings"],
                )

    return run


@dataclass(frozen=True)
class Matches:
    """``documents``: (_doc, _row, n_words), one per row of the corpus. ``exact``
    and ``near``: (_doc, _row, window, start, length). ``items``: (window, item)."""

    documents: DataFrame
    exact: DataFrame
    near: DataFrame
    items: DataFrame


def find(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    slack: int = 3,
) -> Matches:
    """All exact and proximity matches of the items' windows in the documents."""
    spark = docs.sparkSession
    tokens = _keyed(docs, doc_id, text)
    named = settle(item_windows(items, item_id, item_text, n).withColumn("window", F.xxhash64("words")), "windows")
    windows = named.select("window", "words").dropDuplicates(["window"])
    terms = windows.select("window", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))

    wanted = spark.sparkContext.broadcast(slot_bits(terms.select("word").distinct(), "word"))
    counts = tokens.select("_text").mapInArrow(_count(wanted), "word long, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    # A word that no document holds has no count and drops its windows.
    counted = terms.join(counts, "word")
    whole = counted.withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("window"))).filter("known = length")
    rank = F.row_number().over(Window.partitionBy("window").orderBy("n", "offset"))
    anchors = whole.withColumn("rank", rank).filter("rank <= 2").join(windows, "window")
    anchors = settle(anchors.select("window", "length", "words", "offset", "word", "rank"), "anchors")

    looked_for = spark.sparkContext.broadcast(slot_bits(anchors.select("word").distinct(), "word"))
    posting = "array<struct<word:long,at:long,around:array<long>>>"
    schema = StructType([*(tokens.schema[c] for c in KEY), *_fields(f"n_words long, postings {posting}")])
    index = settle(tokens.mapInArrow(_index(looked_for, n), schema), "postings")

    # Offset-adjusted lists: where the window would start.
    lists = index.select(*KEY, F.inline("postings")).join(anchors, "word").withColumn("start", F.col("at") - F.col("offset"))
    here = F.slice("around", F.lit(n) - F.col("offset"), F.col("length"))
    lists = lists.withColumn("same", here == F.col("words")).select(*KEY, "window", "length", "start", "rank", "same")
    first = lists.filter("rank = 1")
    cell = F.floor(F.col("start") / (slack + 1))
    left = first.filter("length > 1").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    right = (
        lists.filter("rank = 2")
        .withColumn("cell", cell)
        .select(*(F.col(c).alias(f"{c}_2") for c in KEY), F.col("window").alias("window_2"), F.col("cell").alias("cell_2"),
                F.col("start").alias("start_2"), F.col("same").alias("same_2"))
    )
    met = (F.col("window") == F.col("window_2")) & (F.col("cell") == F.col("cell_2"))
    for c in KEY:
        met = met & F.col(c).eqNullSafe(F.col(f"{c}_2"))
    pairs = left.join(right, met & (F.abs(F.col("start") - F.col("start_2")) <= slack))
    is_exact = F.col("same") & F.col("same_2") & (F.col("start") == F.col("start_2"))
    place = [*KEY, "window", "start", "length"]
    found = pairs.select(*place, is_exact.alias("exact")).unionByName(
        first.filter("length = 1 and same").select(*place, F.lit(True).alias("exact"))
    )
    found = settle(found.groupBy(*place).agg(F.max("exact").alias("exact")), "matches")
    return Matches(
        index.select(*KEY, "n_words"),
        found.filter("exact").select(*place),
        found.filter("not exact").select(*place),
        named.select("window", "item"),
    )


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def summary(matches: Matches) -> DataFrame:
    """Per row of the corpus: (_doc, _row, n_words, n_hit, items), items as sorted strings."""
    ends = F.max(F.col("start") + F.col("length")).over(
        Window.partitionBy(*KEY).orderBy("start", "length", "window").rowsBetween(Window.unboundedPreceding, -1)
    )
    from_ = F.greatest("start", F.coalesce(ends, F.col("start")))
    hits = matches.exact.withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("length") - from_))
    hits = hits.groupBy(*KEY).agg(F.sum("new").alias("n_hit"))
    named = matches.exact.select(*KEY, "window").distinct().join(matches.items, "window")
    named = named.select(*KEY, F.col("item").cast("string").alias("item")).groupBy(*KEY).agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    out = matches.documents
    for side in (hits, named):
        other = side.withColumnsRenamed({c: f"{c}_r" for c in KEY})
        same = F.col("_doc").eqNullSafe(F.col("_doc_r")) & (F.col("_row") == F.col("_row_r"))
        out = out.join(other, same, "left").drop("_doc_r", "_row_r")
    return out.select(
        *KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean(
    docs: DataFrame, items: DataFrame, limit: Column, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents for which ``limit`` (over n_words, n_hit and items) is not true.

    Only the ids of the rejected documents meet the texts.
    """
    with scratch(docs.sparkSession):
        found = summary(find(docs, items, doc_id, text, **options))
        bad = settle(found.filter("n_hit > 0").filter(limit).select(*KEY).distinct(), "rejected", lasting=True)
    whole = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    same = docs[doc_id].eqNullSafe(bad["_doc"]) & (whole == bad["_row"])
    return docs.join(bad, same, "left_anti")
