"""Exact duplicates against a persistent index of text digests.

The index is a table of (digest, keep_id), one row per different text, bucketed and
sorted by digest and partitioned by the batch that brought the text. A batch of new
documents is reduced to its digests and anti-joined with the index by a sort-merge
join on the buckets, so the index itself is never shuffled; what is left is appended
as a partition of its own. A batch that is run again replaces its partition and sees
only the batches before it, so a failed batch can simply be repeated.

Texts are equal if they are identical after every run of blanks has become one space;
they are compared by SHA-256. Of equal texts the smallest id stays, but one that an
earlier batch brought stays whatever ids follow.

Groups of any size: digests are counted per task before they meet. Of a group's rows
only ids and digests are matched with the group; groups of at least a ``HOT``-th of all
rows, of which there are ``HOT`` at most, are broadcast for that, the others join by
digest.

Defined results: a NULL text counts as empty; blank texts are equal to each other but
not to the empty one. A NULL id stays only if the whole group has none. Rows that
repeat both id and text are counted each, and one of them stays. An empty table leaves
an empty index and no rows. Columns beyond id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .text import free_name

HOT = 1024
#: Rows that one step of the repetition of a row makes.
STEP = 4096
#: A run of blanks that is not a single space already.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normal_text(text: Column) -> Column:
    """Every run of blanks as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUN, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normal text, as 32 bytes."""
    return F.unhex(F.sha2(normal_text(text).cast("binary"), 256))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, copies): one row for each id and text, written once."""
    rows = docs.select(F.col(doc_id).alias("id"), digest(F.col(text)).alias("digest"))
    return settle(rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("copies")), "digests")


@dataclass(frozen=True)
class DigestIndex:
    """The index in one folder; the number of buckets and the type of ids are kept in it."""

    spark: SparkSession
    path: str
    id_type: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str, buckets: int) -> DigestIndex:
        layout = spark.range(1).select(F.lit(id_type).alias("id_type"), F.lit(buckets).alias("buckets"))
        layout.coalesce(1).write.parquet(f"{path}/_layout")
        return cls(spark, path, id_type, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        layout = spark.read.parquet(f"{path}/_layout").first()
        return cls(spark, path, layout.id_type, layout.buckets)

    @property
    def table(self) -> str:
        return f"digest_index_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"

    def entries(self) -> DataFrame:
        """(digest, keep_id, batch) as the folder holds them now."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {self.id_type}, batch INT) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        self.spark.catalog.recoverPartitions(self.table)
        return self.spark.table(self.table)

    def fresh(self, rows: DataFrame, batch: int) -> DataFrame:
        """(digest, keep_id) of the texts that no batch before this one brought."""
        groups = rows.groupBy("digest").agg(F.min("id").alias("keep_id"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            groups = groups.repartition(self.buckets, "digest")
        known = self.entries().filter(F.col("batch") < batch).select("digest").hint("merge")
        return groups.join(known, "digest", "left_anti")

    def admit(self, rows: DataFrame, batch: int) -> None:
        """Append what is new in ``rows`` (as ``digests`` makes them) as partition ``batch``."""
        part = f"{self.table}_{batch}"
        new = self.fresh(rows, batch)
        write = new.write.mode("overwrite").format("parquet").option("path", f"{self.path}/batch={batch}")
        write.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(part)
        self.spark.sql(f"DROP TABLE {part}")  # the files stay: its folder was given

    def groups(self, rows: DataFrame) -> DataFrame:
        """(digest, keep_id, n) of the rows' texts, all of them in the index."""
        sizes = rows.groupBy("digest").agg(F.sum("copies").alias("n"), F.min("id").alias("least"))
        found = sizes.join(self.entries().select("digest", "keep_id").hint("merge"), "digest")
        return found.filter((F.col("n") > 1) | ~F.col("keep_id").eqNullSafe(F.col("least"))).drop("least")


def decisions(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """(id, digest, keep_id, group_size, kept), one row for each document of ``rows``.

    ``rows`` must have been admitted; ``group_size`` counts their documents.
    """
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    named = settle(index.groups(rows), "groups").withColumnRenamed("digest", "of")
    hot = F.broadcast(named.filter(F.col("n") * HOT >= total))
    same = F.col("digest") == F.col("of")
    in_hot = rows.join(hot, same).drop("of")
    rest = rows.join(hot.select("of"), same, "left_anti")
    in_rest = rest.join(named.filter(F.col("n") * HOT < total).withColumn("repeated", F.lit(True)), same, "left").select(
        *rows.columns,
        F.when(F.col("repeated"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("n"),
    )
    found = in_hot.unionByName(in_rest)
    # One row for each copy, in two steps so that no long list is made.
    steps = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(STEP).cast("long"))
    found = found.withColumn("step", F.explode(steps))
    last = F.least(F.col("step") + (STEP - 1), F.col("copies") - 1)
    found = found.withColumn("copy", F.explode(F.sequence("step", last)))
    own = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
    return found.select("id", "digest", "keep_id", F.col("n").cast("long").alias("group_size"), own.alias("kept"))


def admit_in_order(rows: DataFrame, index: DigestIndex, cuts: list, first_batch: int = 1) -> int:
    """Admit the rows batch by batch, cut at ascending ids, NULL ids last; the next batch number.

    Ids ascend from batch to batch, so the smallest one of each group is admitted first.
    """
    edges = [None, *cuts, None]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        part = rows
        if low is not None:
            part = part.filter((F.col("id") >= low) | F.col("id").isNull())
        if high is not None:
            part = part.filter(F.col("id") < high)
        index.admit(part, first_batch + i)
    return first_batch + len(edges) - 1


def keep_first(
    docs: DataFrame, index: DigestIndex, batch: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents of a batch that bring a text first, one row each, with all their columns."""
    rows = digests(docs, doc_id, text)
    index.admit(rows, batch)
    new = index.entries().filter(F.col("batch") == batch).select(F.col("digest").alias("of"), "keep_id")
    mark = free_name(docs, "_digest")
    marked = docs.withColumn(mark, digest(F.col(text))).alias("d")
    stays = (F.col(f"d.{mark}") == F.col("n.of")) & F.col(f"d.{doc_id}").eqNullSafe(F.col("n.keep_id"))
    return marked.join(new.alias("n"), stays, "left_semi").dropDuplicates([mark, doc_id]).drop(mark)
