"""Write web pages as WARC archives, and read archives back safely.

Writing: one record per page. Of pages with equal payloads the one with the least
id is a ``response``, the others are ``revisit`` records that refer to it and hold
no payload. Archives are written by Spark's text writer, one file per task, with
the record end as line end.

Reading: the version line of a record is looked for everywhere, also where a file is
split, by Spark's text reader with that line as separator. Each place it occurs is
a candidate record, whose header says where its successor must begin. Pointer
jumping from the start of each file keeps only the candidates that a chain of
records reaches: every round doubles the reach and the length of all jumps. So a
version line inside a payload is never taken for a record, and a payload that holds
one is put together again from its pieces.

Built-in functions do all but the running offset of a piece in its split, which is
summed where the piece is read (Arrow), so that texts are not shuffled for it. Files
of any size are read in splits; pieces are given to their records in bins of a file.

Defined results: a NULL payload is empty; blanks and control characters of a URL
are removed, a NULL URL is left out; a NULL id is written as ``null``, is above all
others and read back as NULL; rows with the same least id and payload are all
responses. Bytes after a break in a chain of records are not read. An empty table
writes archives without records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import settle

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
ID = "urn:tidemark:page:"
#: Bytes of a file whose pieces are given to their records in one group.
BIN = 1 << 22


def digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data."""
    hexed = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexed, 1 + 10 * g, 10), 16, 32), 8, "0") for g in range(4)
    ]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One record per page as text, without its end: column ``value``."""
    body = F.coalesce(F.col(html), F.lit(""))
    base = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), body.alias("_body"))
    base = base.withColumn("_digest", digest(F.encode("_body", "UTF-8")))
    # Only payloads that occur again matter. Written first, so that Spark knows their size when it joins.
    firsts = base.groupBy(F.col("_digest").alias("_same")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = settle(firsts.filter("_n > 1").drop("_n"), "repeated")
    met = base.join(firsts, F.col("_digest") == F.col("_same"), "left")
    revisit = F.col("_same").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    name = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.octet_length("_body").cast("string")),
        F.lit("\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "_body"))
    clean = F.regexp_replace("_url", r"[\x00-\x20\x7F]", "")
    return met.withColumn("_block", block).select(
        F.concat(
            F.lit(MAGIC),
            line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            line("WARC-Record-ID", name("_id")),
            line("WARC-Date", F.lit(date)),
            F.when(clean.isNotNull(), line("WARC-Target-URI", clean)).otherwise(""),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "_digest")),
            F.when(revisit, line("WARC-Refers-To", name("_first"))).otherwise(""),
            F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
            line("Content-Type", F.lit("application/http; msgtype=response")),
            line("Content-Length", F.octet_length("_block").cast("string")),
            F.lit("\r\n"),
            F.col("_block"),
        ).alias("value")
    )


def write(pages: DataFrame, path: str, **options) -> None:
    records(pages, **options).write.option("lineSep", END).text(path)


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between version lines, in the order of each split."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
        "value",
    )


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """(file_, split_, base): where the first piece of each split begins; a row per split."""
    sums = _scan(spark, path).groupBy("file", "split").agg(F.sum("size").alias("all"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("all").over(before), F.lit(0))
    return settle(sums.select(F.col("file").alias("file_"), F.col("split").alias("split_"), base.alias("base")), "splits")


def _run_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the size of what comes before each piece in its split."""
    last, total, begun = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        names, splits = batch["file"].dictionary_encode(), batch["split"].to_numpy()
        codes, sizes = names.indices.to_numpy(), batch["size"].to_numpy()
        new = np.ones(len(sizes), dtype=bool)
        new[1:] = (codes[1:] != codes[:-1]) | (splits[1:] != splits[:-1])
        new[0] = last != (names[0].as_py(), splits[0])
        before = total + np.cumsum(sizes) - sizes
        starts = np.maximum.accumulate(np.where(new, before, begun))
        last, total, begun = (names[-1].as_py(), splits[-1]), before[-1] + sizes[-1], starts[-1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(before - starts, pa.int64())], [*batch.schema.names, "within"]
        )


def _placed(rows: DataFrame, bases: DataFrame) -> DataFrame:
    """Add ``at``, the offset of each piece in its file.

    The reader gives no offsets, but hands out every byte of a file exactly once and
    in order within a split, so an offset is the sum of what comes before: in the
    split, and in the splits before it.
    """
    summed = rows.mapInArrow(_run_sums, StructType([*rows.schema, StructField("within", LongType())]))
    met = summed.join(bases, (F.col("file") == F.col("file_")) & (F.col("split") == F.col("split_")))
    kept = [c for c in rows.columns if c != "split"]
    return met.select(*kept, (F.col("base") + F.col("within")).alias("at"))


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", F.trim(found))


def parsed(rows: DataFrame) -> DataFrame:
    """Read the header at the start of each ``value``; NULL fields where there is none."""
    head = F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1))
    out = rows.withColumn("_head", head)
    out = out.withColumns(
        {
            "type": _field(F.col("_head"), "WARC-Type"),
            "id": _field(F.col("_head"), "WARC-Record-ID"),
            "refers_to": _field(F.col("_head"), "WARC-Refers-To"),
            "named_digest": _field(F.col("_head"), "WARC-Payload-Digest"),
            "body_from": (F.octet_length("_head") + len(END)).cast("long"),
            "body_size": _field(F.col("_head"), "Content-Length").try_cast("long"),
        }
    ).drop("_head")
    binary = F.col("value").cast("binary")
    # A header may claim any length, so it is held against the piece before any sum.
    held = F.least(F.col("body_size"), F.octet_length(binary).cast("long")).cast("int")
    block = F.substring(binary, (F.col("body_from") + 1).cast("int"), held).cast("string")
    out = out.withColumn("_block", F.when(F.col("body_size") >= 0, block))
    http = F.when(F.instr("_block", END) > 0, F.substring_index("_block", END, 1))
    out = out.withColumn("_http", http)
    start = F.octet_length("_http") + len(END) + 1
    payload = F.substring(F.col("_block").cast("binary"), start, F.octet_length("_block"))
    return out.withColumns(
        {
            "payload_bytes": _field(F.col("_http"), "Content-Length").try_cast("long"),
            "held_bytes": F.octet_length(payload).cast("long"),
            "held_digest": digest(payload),
        }
    ).drop("_block", "_http")


def reachable(candidates: DataFrame) -> DataFrame:
    """Of (file, start, next), the (file, start) that chains from offset 0 reach.

    ``file`` is a hash of the name, as the rows are shuffled in every round.
    """
    state = candidates.select("file", "start", F.col("next").alias("jump"), (F.col("start") == 0).alias("reached"))
    state, seen = settle(state, "chain"), -1
    while True:
        for _ in range(2):
            far = state.select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("jump").alias("j"))
            hit = state.filter("reached").select(F.col("file").alias("hf"), F.col("jump").alias("hs")).distinct()
            state = (
                state.join(far, (F.col("file") == F.col("f")) & (F.col("jump") == F.col("s")), "left")
                .join(hit, (F.col("file") == F.col("hf")) & (F.col("start") == F.col("hs")), "left")
                .select("file", "start", F.col("j").alias("jump"), (F.col("reached") | F.col("hs").isNotNull()).alias("reached"))
            )
        state = settle(state, "chain")
        count = state.filter("reached").count()
        if count == seen:
            return state.filter("reached").select("file", "start")
        seen = count


def _pieces_of(records: DataFrame, table: DataFrame) -> DataFrame:
    """(file_key, at, start): the pieces of each record (file_key, start, next), with the record's start.

    Records do not overlap. Each leaves a mark in every bin of the file that it
    reaches, so that the last mark before a piece is found inside its bin. A record
    that claims more than the file ends with the file.
    """
    ends = table.groupBy("file_key").agg(F.max(F.col("at") + F.col("size")).alias("end"))
    held = records.join(ends, "file_key").select("file_key", "start", F.least("next", "end").alias("next"))
    of = lambda place: F.floor(place / BIN).cast("long")
    marks = held.select("*", F.explode(F.sequence(of(F.col("start")), of(F.col("next") - 1))).alias("bin")).select(
        "file_key",
        "bin",
        F.greatest(F.col("start"), F.col("bin") * BIN).alias("place"),
        F.lit(None).cast("long").alias("at"),
        F.struct("start", "next").alias("mark"),
    )
    pieces = table.select(
        "file_key",
        of(F.col("start")).alias("bin"),
        F.col("start").alias("place"),
        "at",
        F.lit(None).cast("struct<start:bigint,next:bigint>").alias("mark"),
    )
    order = Window.partitionBy("file_key", "bin").orderBy("place", F.col("at").asc_nulls_first())
    owner = F.last("mark", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    owned = marks.unionByName(pieces).withColumn("owner", owner)
    return owned.filter("at is not null and place < owner.next").select("file_key", "at", F.col("owner.start").alias("start"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below a path.

    ``file``, ``start``, ``type``, ``id``, ``refers_to``, ``named_digest``, the
    payload's length by its HTTP header (``payload_bytes``), and of what the record
    holds length and digest (``held_bytes``, ``held_digest``).
    """
    bases = _bases(spark, path)
    # Pieces are read where they are scanned; only what was read of them goes on.
    rows = _placed(parsed(_scan(spark, path)).drop("value"), bases)
    size = F.col("size") - len(MAGIC)
    wanted = F.try_add(F.col("body_from") + len(END), F.col("body_size"))
    table = settle(
        rows.select(
            *rows.columns,
            F.xxhash64("file").alias("file_key"),
            (F.col("at") - len(MAGIC)).alias("start"),
            F.when((F.col("body_size") >= 0) & F.col("type").isNotNull(), F.try_add("at", wanted)).alias("next"),
            F.coalesce(size == wanted, F.lit(False)).alias("whole"),
        ).filter("start >= 0"),
        "candidates",
    )
    chains = table.filter("next is not null").select(F.col("file_key").alias("file"), "start", "next")
    kept = settle(reachable(chains), "kept").withColumnRenamed("file", "file_key")
    found = table.join(kept, ["file_key", "start"])
    fields = ["type", "id", "refers_to", "named_digest", "payload_bytes", "held_bytes", "held_digest"]
    whole = found.filter("whole").select("file", "start", *fields)
    # Records whose payload holds a version line: their pieces, in order, make them whole.
    parts = settle(_pieces_of(found.filter("not whole").select("file_key", "start", "next"), table), "parts")
    texts = _placed(_scan(spark, path), bases).withColumn("file_key", F.xxhash64("file")).join(parts, ["file_key", "at"])
    texts = texts.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("p"))
    joined = parsed(texts.select("file", "start", F.array_join(F.transform("p", lambda x: x["value"]), MAGIC).alias("value")))
    return whole.unionByName(joined.select("file", "start", *fields))


def page_key(name: Column) -> Column:
    """The page id in a record name."""
    return F.regexp_extract(name, rf"{ID}(.*)>", 1)
