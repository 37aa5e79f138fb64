"""Streams into versioned tables: a snapshot log, arrival numbers, checked messages, a live view.

Each batch is written to folders of its own and then committed as one version
(``versions``), whatever number of tables it concerns. ``versions.read_table`` reads
them. The batch functions can be called without a stream, batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.snapshot import ALL, RESET_HOURS, STORE_SIZE, filter_snapshot, last_messages, latest_snapshot, store_kpis
from ..sources import messages as intake
from .live import _start, latest_per_entity
from .versions import Versions, read_table


def _each(stream: DataFrame, mode: str, checkpoint: str, live: bool, add: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return _start(stream.writeStream.outputMode(mode).foreachBatch(add), checkpoint, live)


# -- snapshot --------------------------------------------------------------------


def add_changes(batch: DataFrame, batch_id: int, path: str) -> None:
    """One batch of changed rows into a snapshot log."""
    versions = Versions(batch.sparkSession, path)
    if versions.committed(batch_id):
        return
    held = versions.newest(before=batch_id)["folders"].get("changes", [])
    folder = versions.write(batch, "changes", batch_id)
    folders = versions.appended(held, folder, "changes", batch_id, batch.schema, latest_snapshot)
    versions.commit(batch_id, {"folders": {"changes": folders}, "schemas": {"changes": batch.schema.jsonValue()}})


def write_snapshot_log(stream: DataFrame, path: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Log of changed snapshot rows that merges its old batches in place.

    Neighbouring batches are merged to their latest row per facility, so the log has
    a few folders for any number of batches. Readers and the running stream go by the
    manifest, which names whole folders only.
    """
    return _each(latest_per_entity(stream), "update", checkpoint, live, lambda b, i: add_changes(b, i, path))


def read_snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    return latest_snapshot(read_table(spark, path, "changes"))


# -- arrival numbers -------------------------------------------------------------


def add_arrivals(batch: DataFrame, batch_id: int, path: str, order: Sequence[str] = intake.ARRIVAL, name: str = "arrival_seq") -> None:
    """Number a batch on from the versions before it and append it.

    The next number is part of the version, so a batch that is repeated gets the
    numbers it would have got. It comes from the write itself, not from a count.
    """
    versions = Versions(batch.sparkSession, path)
    if versions.committed(batch_id):
        return
    state = versions.newest(before=batch_id)
    first = state.get("next", 0)
    rows = Observation()
    numbered = intake.number_arrivals(batch, order, name, first)
    folder = versions.write(numbered.observe(rows, F.count(F.lit(1)).alias("n")), "arrivals", batch_id)
    schema = numbered.schema
    folders = versions.appended(state["folders"].get("arrivals", []), folder, "arrivals", batch_id, schema)
    versions.commit(
        batch_id,
        {"folders": {"arrivals": folders}, "schemas": {"arrivals": schema.jsonValue()}, "next": first + rows.get["n"]},
    )


def write_arrivals(
    stream: DataFrame, path: str, checkpoint: str, order: Sequence[str] = intake.ARRIVAL, name: str = "arrival_seq", live: bool = False
) -> StreamingQuery:
    """Dense arrival numbers over a stream, batch after batch; the table is ``arrivals``.

    Messages that give no time of receipt get that of their batch.
    """
    add = lambda b, i: add_arrivals(intake.stamp_receipt(b), i, path, order, name)
    return _each(stream, "append", checkpoint, live, add)


# -- checked messages ------------------------------------------------------------


def add_checked(batch: DataFrame, batch_id: int, path: str, body: str = "body", topic: str = "topic") -> None:
    """Split a batch into ``messages`` (normalized) and ``quarantine`` (raw, with a reason).

    One pass: bodies are parsed once, both kinds go to one write, and one version
    makes both visible.
    """
    versions = Versions(batch.sparkSession, path)
    if versions.committed(batch_id):
        return
    state = versions.newest(before=batch_id)
    checked = intake.check_messages(batch, body).withColumn("kind", F.when(F.col("reason").isNull(), "messages").otherwise("quarantine"))
    kept = [c for c in batch.columns if c not in (body, topic)]
    good = F.col("kind") == "messages"
    both = intake.normalize_checked(checked, [*kept, F.when(~good, F.col(body)).alias("_body"), "reason", "kind"], topic)
    counts = Observation()
    seen = both.observe(counts, F.count_if(good).alias("messages"), F.count_if(~good).alias("quarantine"))
    folder = versions.write(seen, "checked", batch_id, "kind")
    fields = {f.name: f for f in both.schema.fields}
    normal = [f for f in both.columns if f not in ("_body", "reason", "kind")]
    columns = {"messages": normal, "quarantine": [*kept, topic, "_body", "reason"]}
    folders, schemas = dict(state["folders"]), {}
    for kind, names in columns.items():
        schema = type(both.schema)([fields[c] for c in names])
        schemas[kind] = schema.jsonValue()
        held = folders.get(kind, [])
        part = f"{folder}/kind={kind}"
        folders[kind] = versions.appended(held, part, kind, batch_id, schema) if counts.get[kind] else held
    total = {k: state.get("rows", {}).get(k, 0) + counts.get[k] for k in columns}
    versions.commit(batch_id, {"folders": folders, "schemas": schemas, "rows": total, "body": body})


def write_checked(
    stream: DataFrame, path: str, checkpoint: str, body: str = "body", topic: str = "topic", live: bool = False
) -> StreamingQuery:
    """A stream of raw messages into the tables ``messages`` and ``quarantine``."""
    return _each(stream, "append", checkpoint, live, lambda b, i: add_checked(b, i, path, body, topic))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The messages set aside, as they came, with the reason."""
    body = Versions(spark, path).newest()["body"]
    return read_table(spark, path, "quarantine").withColumnRenamed("_body", body)


# -- live view with resets since the last reset ------------------------------------


def add_refresh(
    batch: DataFrame, batch_id: int, path: str, n: int = STORE_SIZE, hours: float = RESET_HOURS, received: str = "received_us"
) -> None:
    """Take a batch into the store of the newest ``n`` messages, then refresh.

    A refresh tests whether ``hours`` have gone by since the last reset, by the newest
    time of receipt so far; if so, all that is held is cleared, this batch too, and
    the clock starts from there (never if 0). It starts with the first time received.
    So a reset comes with the first refresh after the interval, wherever that falls.

    The batch is read once: its count and times come with the write of the store,
    and nothing else is written but the manifest. A message without a time counts
    and is stored, but moves no clock.
    """
    if n < 1:
        raise ValueError("the store must hold a message")
    versions = Versions(batch.sparkSession, path)
    if versions.committed(batch_id):
        return
    state = versions.newest(before=batch_id)
    seen = Observation()
    counted = batch.observe(seen, F.count(F.lit(1)).alias("n"), F.min(received).alias("low"), F.max(received).alias("high"))
    store = last_messages(counted, n)
    held = state["folders"].get("store", [])
    if held:
        store = last_messages(versions.read([f for f, _ in held], batch.schema).unionByName(store), n)
    folders = [[versions.write(store, "store", batch_id), 0]]
    got = seen.get
    last = max((t for t in (state.get("last_us"), got["high"]) if t is not None), default=None)
    begun = state.get("last_reset_us")
    begun = got["low"] if begun is None else begun
    since, resets = state.get("since", 0) + got["n"], state.get("resets", 0)
    if hours > 0 and last is not None and last - begun >= int(hours * 3600 * 1_000_000):
        folders, begun, since, resets = [], last, 0, resets + 1
    versions.commit(
        batch_id,
        {
            "folders": {"store": folders},
            "schemas": {"store": batch.schema.jsonValue()},
            "total": state.get("total", 0) + got["n"],
            "since": since,
            "resets": resets,
            "last_us": last,
            "last_reset_us": begun,
        },
    )


def write_refreshes(
    stream: DataFrame, path: str, checkpoint: str, n: int = STORE_SIZE, hours: float = RESET_HOURS, received: str = "received_us", live: bool = False
) -> StreamingQuery:
    """The live view of a stream, refreshed after each batch; the table is ``store``."""
    return _each(stream, "append", checkpoint, live, lambda b, i: add_refresh(b, i, path, n, hours, received))


def refresh_kpis(spark: SparkSession, path: str) -> DataFrame:
    """KPIs over the store, which has ``n`` rows at most."""
    return store_kpis(latest_snapshot(read_table(spark, path, "store")))


def refresh_status(spark: SparkSession, path: str, fuel: str = ALL, region: str = ALL) -> DataFrame:
    """One row: totals, resets, times, and facilities in the store."""
    state = Versions(spark, path).newest()
    shown = latest_snapshot(read_table(spark, path, "store"))
    number = lambda name: F.lit(state.get(name)).cast("bigint")
    return spark.range(1).select(
        number("total").alias("total_messages"),
        number("since").alias("messages_since_reset"),
        number("resets").alias("resets"),
        number("last_us").alias("last_update_us"),
        number("last_reset_us").alias("last_reset_us"),
        ((number("last_us") - number("last_reset_us")) / 1e6).alias("seconds_since_reset"),
        shown.agg(F.count(F.lit(1))).scalar().alias("facilities"),
        filter_snapshot(shown, fuel, region).agg(F.count(F.lit(1))).scalar().alias("facilities_shown"),
    )
