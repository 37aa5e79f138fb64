"""Drop lines that many documents repeat, keeping one document's copies.

Lines become narrow rows (key hash, document, position). They are range-
partitioned by key hash with documents and positions as secondary order, so one
pass over a sorted partition sees the first occurrence of a key - its largest
document - before all others and decides line by line. The range includes the
document, so a key that holds a third of all lines is spread over many
partitions; the few keys that cross a partition bound (one per bound at most) are
summed up beforehand and their decision is broadcast.

The result is a compressed bitmap of kept lines per document, not text; ``apply``
turns it into text where that is wanted.

Keys are compared by two 64-bit hashes of the whole key.

Defined results: a NULL or empty text is one empty line; rows with the same
document id are one document when documents are counted; a NULL id is below all
others; lines shorter than ``min_chars`` are always kept; an empty table gives no
bitmaps. A text that loses all lines becomes empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..operators.ordered import assign_slices
from ..session import scratch, settle
from .text import BLANKS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["_h1", "_h2"]


def line_rows(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(_h1, _h2, _doc, _row, _pos) of every line that is long enough to count."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc_id).alias("_doc"), F.xxhash64(whole).alias("_row"), F.posexplode(F.split(whole, "\n")).alias("_pos", "_line")
    )
    keyed = lines.withColumn("_key", F.translate(F.btrim("_line", F.lit(BLANKS)), UPPER, LOWER))
    return keyed.filter(F.length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"), "_doc", "_row", "_pos"
    )


def crossing_keys(sliced: DataFrame, min_docs: int) -> DataFrame:
    """(_h1, _h2, _docs, _keeper) of the keys that lie in more than one slice.

    One key per slice bound at most, so the frame is small whatever the input.
    Their documents are counted after removing repeats in parallel.
    """
    at = F.struct(*KEY)
    ends = sliced.groupBy("_slice").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    bounds = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("k"), "_slice")
    crossing = bounds.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k.*")
    rows = sliced.join(F.broadcast(crossing), KEY, "left_semi").select(*KEY, "_doc").distinct()
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_docs"), F.max("_doc").alias("_keeper"))


def _changed(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it (NULL equals NULL)."""
    out = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        a, b = column[1:], column[:-1]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        out[1:] = ~same.to_numpy(zero_copy_only=False)
    return out


def _decide(rows: pa.Table, min_docs: int) -> pa.Table:
    """The rows to drop; every key is either whole in here or carries its decision."""
    doc = rows["_doc"].combine_chunks()
    new_key = _changed(rows["_h1"].combine_chunks()) | _changed(rows["_h2"].combine_chunks())
    new_doc = new_key | _changed(doc)
    starts = np.flatnonzero(new_key)
    docs = np.add.reduceat(new_doc.astype(np.int64), starts)
    group = np.cumsum(new_key) - 1
    nth = np.cumsum(new_doc)
    drop = (docs[group] >= min_docs) & (nth > nth[starts][group])
    given = rows["_docs"].combine_chunks()
    crossing = pc.is_valid(given).to_numpy(zero_copy_only=False)
    if crossing.any():
        keeper = rows["_keeper"].combine_chunks()
        is_keeper = pc.or_(
            pc.fill_null(pc.equal(doc, keeper), False), pc.and_(pc.is_null(doc), pc.is_null(keeper))
        ).to_numpy(zero_copy_only=False)
        many = pc.fill_null(given, 0).to_numpy(zero_copy_only=False) >= min_docs
        drop = np.where(crossing, many & ~is_keeper, drop)
    return rows.select(["_doc", "_row", "_pos"]).filter(pa.array(drop))


def _stream(min_docs: int):
    """Pass over sorted rows; the last key of a batch waits for the next one.

    A crossing key never waits, so what waits is part of one slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            here = pa.Table.from_batches([batch])
            changes = np.flatnonzero(_changed(batch["_h1"]) | _changed(batch["_h2"]))
            if waiting:
                last, first = waiting[-1].slice(waiting[-1].num_rows - 1), here.slice(0, 1)
                if all(last[c][0].as_py() == first[c][0].as_py() for c in KEY):
                    changes = changes[1:]
            # Everything before the last change is whole now.
            if batch["_docs"][batch.num_rows - 1].is_valid:
                done, rest = here, here.slice(0, 0)
            elif len(changes):
                done, rest = here.slice(0, changes[-1]), here.slice(changes[-1])
            else:
                waiting.append(here)
                continue
            ready = pa.concat_tables([*waiting, done])
            waiting = [rest] if rest.num_rows else []
            if ready.num_rows:
                yield from _decide(ready, min_docs).to_batches()
        if waiting:
            yield from _decide(pa.concat_tables(waiting), min_docs).to_batches()

    return run


@F.pandas_udf(BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    """Compressed keep bits up to the last dropped line; lines behind it are kept."""

    def pack(dropped):
        keep = np.ones((int(max(dropped)) // 8 + 1) * 8, dtype=bool)
        keep[np.asarray(dropped)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return positions.map(pack)


def kept_lines(text: str, bitmap: bytes | None) -> str | None:
    if bitmap is None:
        return text
    lines = (text or "").split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
    keep = np.concatenate([keep[: len(lines)], np.ones(max(0, len(lines) - len(keep)), dtype=np.uint8)])
    return "\n".join(line for line, k in zip(lines, keep) if k)


@F.pandas_udf(StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    return pd.Series([kept_lines(t, b) for t, b in zip(text, bitmap)], dtype=object)


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    slices: int | None = None,
) -> DataFrame:
    """(_doc, _row, n_dropped, keep) of the documents that lose lines.

    ``_row`` is the hash of the whole text, which tells rows with the same id
    apart. ``keep`` is the compressed bitmap of kept lines.
    """
    lines = settle(line_rows(docs, doc_id, text, min_chars), "lines")
    sliced = assign_slices(lines, [*KEY, "_doc", "_pos"], slices)
    crossing = crossing_keys(sliced, min_docs)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        sliced.join(F.broadcast(crossing), KEY, "left")
        .repartition(tasks, "_slice")
        .sortWithinPartitions("_slice", *KEY, F.col("_doc").desc_nulls_last(), "_pos")
    )
    kind = lines.schema["_doc"].dataType
    schema = StructType([StructField("_doc", kind), *(f for f in lines.schema if f.name in ("_row", "_pos"))])
    dropped = ordered.mapInArrow(_stream(min_docs), schema)
    per_row = dropped.distinct().groupBy("_doc", "_row").agg(F.collect_list("_pos").alias("_at"))
    return per_row.select("_doc", "_row", F.size("_at").cast(LongType()).alias("n_dropped"), _bitmap("_at").alias("keep"))


def apply(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with only the kept lines, and ``n_lines`` and ``n_dropped``."""
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.struct(*kept).alias("_kept"),
        F.col(doc_id).alias("_doc_key"),
        F.xxhash64(whole).alias("_row_key"),
        F.size(F.split(whole, "\n")).cast("long").alias("_lines"),
    )
    same = F.col("_doc_key").eqNullSafe(F.col("_doc")) & (F.col("_row_key") == F.col("_row"))
    joined = keyed.join(bitmaps, same, "left")
    old = lambda c: F.col("_kept").getField(c)
    return joined.select(
        *(_kept(old(c), F.col("keep")).alias(c) if c == text else old(c).alias(c) for c in kept),
        F.col("_lines").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    with scratch(docs.sparkSession):
        bitmaps = settle(keep_bitmaps(docs, doc_id, text, **options), "bitmaps", lasting=True)
    return apply(docs, bitmaps, doc_id, text)
