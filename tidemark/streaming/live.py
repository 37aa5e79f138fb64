"""The live side as Structured Streaming queries.

Every sink can repeat a batch: files of a batch go to a folder named after the
batch, written in overwrite mode, so a batch replayed after a failure replaces
itself. ``live=False`` runs over what is there and stops (tests, catch-up).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.publish import TOPIC_ROOT, publish_messages, stamp_sent
from ..operators.snapshot import (
    ALL,
    RESET_HOURS,
    STORE_SIZE,
    filter_snapshot,
    last_messages,
    latest_snapshot,
    reset_epoch,
    snapshot_kpis,
    store_kpis,
)
from .seen import SeenKeys, day_of
from .versions import Versions

REFRESH = "3 seconds"
SLOTS = 4
BATCH = "batch_id"


def _start(writer: DataStreamWriter, checkpoint: str, live: bool) -> StreamingQuery:
    trigger = {"processingTime": REFRESH} if live else {"availableNow": True}
    query = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if not live:
        query.awaitTermination()
    return query


def append_table(stream: DataFrame, path: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Append a stateless stream to a Parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, live)


def publish_rows(
    stream: DataFrame, path: str, checkpoint: str, topic_root: str = TOPIC_ROOT, live: bool = False
) -> StreamingQuery:
    """Send numbered rows as messages: JSON lines (``topic``, ``seq``, ``body``) in a folder per batch.

    The checkpoint holds what has been sent, so a restart goes on behind it, and a
    batch sent again replaces its own folder. The time of sending is set here.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        sent = publish_messages(stamp_sent(batch), topic_root)
        sent.write.mode("overwrite").json(f"{path}/{BATCH}={batch_id}")

    return _start(stream.writeStream.outputMode("append").foreachBatch(sink), checkpoint, live)


def latest_per_entity(stream: DataFrame, entity: str = "facility_code", arrival: str = "arrival_seq") -> DataFrame:
    """Running last message per facility; in update mode only changed ones are sent on."""
    rest = [c for c in stream.columns if c != entity]
    last = stream.groupBy(entity).agg(F.max_by(F.struct(*rest), arrival).alias("_m"))
    return last.select(entity, *(F.col(f"_m.{c}").alias(c) for c in rest))


def write_changes(stream: DataFrame, path: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Log of changed snapshot rows, one folder per batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = latest_per_entity(stream).writeStream.outputMode("update").foreachBatch(sink)
    return _start(writer, checkpoint, live)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot a change log amounts to."""
    return latest_snapshot(spark.read.parquet(path).drop(BATCH))


def compact_changes(spark: SparkSession, path: str, target: str) -> None:
    """Write the snapshot as a new log with one entry, for a long-running log."""
    read_changes(spark, path).write.mode("overwrite").parquet(f"{target}/{BATCH}=-1")


def _slot(path: str, batch_id: int) -> str:
    return f"{path}/slot={batch_id % SLOTS}"


def _write_slot(df: DataFrame, path: str, batch_id: int) -> None:
    df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").parquet(_slot(path, batch_id))


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table kept in rotating slots."""
    versions = spark.read.option("ignoreMissingFiles", True).parquet(path)
    newest = versions.agg(F.max(BATCH)).scalar()
    return versions.filter(F.col(BATCH) == newest).drop("slot", BATCH)


def _version(spark: SparkSession, path: str, table: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(_slot(f"{path}/{table}", batch_id)).filter(F.col(BATCH) == batch_id).drop(BATCH)


def write_view(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    n: int = STORE_SIZE,
    hours: float = RESET_HOURS,
    received: str = "received_us",
    live: bool = False,
) -> StreamingQuery:
    """What a dashboard shows, after each batch: the newest ``n`` messages since the
    last soft reset (``store``), their KPIs (``kpis``) and the counts (``status``).

    A batch starts from the version of the batch before and writes the next slot
    of each table, ``status`` last. Readers take the version that ``status``
    names, so they meet neither a half-written table nor one being replaced.
    A batch costs its own rows and the bounded store, whatever came before.
    """
    span = int(hours * 3600 * 1_000_000)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.agg(F.count(F.lit(1)).alias("n"), F.min(received).alias("low"), F.max(received).alias("high")).first()
        old = _version(spark, path, "status", batch_id - 1).first() if batch_id > 0 else None
        known = [r for r in (old and old["first_us"], seen["low"]) if r is not None]
        first = min(known) if known else None
        lasts = [r for r in (old and old["last_us"], seen["high"]) if r is not None]
        last = max(lasts) if lasts else None
        epoch = (last - first) // span if span > 0 and known else 0
        begin = F.lit(first).cast("bigint")
        held = batch
        if batch_id > 0:
            held = _version(spark, path, "store", batch_id - 1).unionByName(last_messages(batch, n))
        here = reset_epoch(F.col(received), begin, hours) == epoch
        new = batch.filter(here).count()
        since = new + (old["messages_since_reset"] if old and old["epoch"] == epoch else 0)
        _write_slot(last_messages(held.filter(here), n), f"{path}/store", batch_id)
        shown = latest_snapshot(_version(spark, path, "store", batch_id))
        _write_slot(store_kpis(shown), f"{path}/kpis", batch_id)
        total = seen["n"] + (old["total_messages"] if old else 0)
        status = spark.range(1).select(
            F.lit(total).cast("bigint").alias("total_messages"),
            F.lit(since).cast("bigint").alias("messages_since_reset"),
            F.lit(epoch).cast("bigint").alias("epoch"),
            begin.alias("first_us"),
            F.lit(last).cast("bigint").alias("last_us"),
            F.lit(span).cast("bigint").alias("span_us"),
        )
        _write_slot(status, f"{path}/status", batch_id)

    return _start(stream.writeStream.outputMode("append").foreachBatch(sink), checkpoint, live)


def read_view(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``store``, ``kpis`` or ``status`` of the newest complete batch."""
    versions = spark.read.option("ignoreMissingFiles", True).parquet(f"{path}/status")
    newest = versions.agg(F.max(BATCH)).first()[0]
    return _version(spark, path, table, newest)


def view_status(
    spark: SparkSession, path: str, n: int = STORE_SIZE, fuel: str = ALL, region: str = ALL, received: str = "received_us"
) -> DataFrame:
    """The status line of the view, with the columns of ``snapshot.stream_status``."""
    store = read_view(spark, path, "store")
    shown = latest_snapshot(store)
    reset_at = F.col("first_us") + F.col("epoch") * F.col("span_us")
    updated = store.agg(F.max(received)).scalar()
    return read_view(spark, path, "status").select(
        "total_messages",
        "messages_since_reset",
        F.least("messages_since_reset", F.lit(n).cast("bigint")).alias("store_size"),
        updated.alias("last_update_us"),
        reset_at.alias("last_reset_us"),
        ((updated - reset_at) / 1e6).alias("seconds_since_reset"),
        shown.agg(F.count(F.lit(1))).scalar().alias("facilities"),
        filter_snapshot(shown, fuel, region).agg(F.count(F.lit(1))).scalar().alias("facilities_shown"),
    )


def write_last_n(
    stream: DataFrame, path: str, checkpoint: str, n: int = STORE_SIZE, live: bool = False
) -> StreamingQuery:
    """Bounded store of the newest ``n`` messages. A batch reads the version of the
    batch before and writes the next slot, so repeating it gives the same store."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        store = last_messages(batch, n)
        if batch_id > 0:
            held = batch.sparkSession.read.parquet(_slot(path, batch_id - 1))
            store = last_messages(held.drop(BATCH).unionByName(store), n)
        _write_slot(store, path, batch_id)

    return _start(stream.writeStream.outputMode("append").foreachBatch(sink), checkpoint, live)


def write_kpis(
    stream: DataFrame, path: str, checkpoint: str, live: bool = False
) -> StreamingQuery:
    """Snapshot and its KPIs after each batch, below ``path``.

    The snapshot is written first and the KPIs are computed from the written
    table: an aggregation on top of a streaming aggregation is not allowed, and
    the state is read once only.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_slot(batch, f"{path}/snapshot", batch_id)
        written = batch.sparkSession.read.parquet(_slot(f"{path}/snapshot", batch_id))
        _write_slot(snapshot_kpis(written, settled=True), f"{path}/kpis", batch_id)

    writer = latest_per_entity(stream).writeStream.outputMode("complete").foreachBatch(sink)
    return _start(writer, checkpoint, live)


def without_repeats(
    stream: DataFrame, key: str = "seq", received: str = "received_at", delay: str = "1 hour"
) -> DataFrame:
    """Drop messages delivered again within ``delay``. Optional: by default repeats
    pass and only the sequence check reports them.

    A message that arrives more than ``delay`` behind the newest one is dropped
    as well, also if it is its first delivery: choose ``delay`` accordingly, or
    use ``write_once``, which keeps it.
    """
    return stream.withWatermark(received, delay).dropDuplicatesWithinWatermark([key])


def write_once(
    stream: DataFrame, path: str, checkpoint: str, key: str = "seq", received: str = "received_at", live: bool = False
) -> StreamingQuery:
    """Write the first delivery of each key, however late it comes; one folder per batch.

    No watermark drops a message and no state is held in memory: ``seen`` keeps the
    keys beside the table, in ``_seen``, with a filter for each day, so a batch costs
    its own rows, the filters and the days it repeats. A batch sent again sees the
    keys of the batches before it and replaces its own folder. Of deliveries in one
    batch the one received first stays; NULL is a key of its own.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, kind = batch.sparkSession, batch.schema[key].dataType.simpleString()
        versions = Versions(spark, f"{path}/_seen")
        if versions.committed(batch_id):
            return
        keys = SeenKeys(versions, kind)
        state = versions.newest(before=batch_id) | {"number": batch_id}
        rest = [received, *(c for c in batch.columns if c not in (key, received))]
        first = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_m"))
        new = first.select(*(F.col(c if c == key else f"_m.{c}").alias(c) for c in batch.columns))
        if state.get("days"):
            known = keys.known(state, first.select(F.col(key).alias("key")))
            if known is not None:
                new = new.join(known, new[key].eqNullSafe(known["key"]), "left_anti")
        folder = f"{path}/{BATCH}={batch_id}"
        new.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(new.schema).parquet(folder)
        state = keys.add(state, written.select(F.col(key).alias("key"), day_of(F.col(received)).alias("day")))
        versions.commit(batch_id, state)

    return _start(stream.writeStream.outputMode("append").foreachBatch(sink), checkpoint, live)
