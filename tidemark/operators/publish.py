"""Ordered, resumable message stream out of a measurement table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import GRID_ZONE, iso_text
from ..schemas import METRIC_UNIT
from .ordered import number_rows

# Tick of the replay, fields of a message in their order.
TICK_MS = 100
TOPIC_ROOT = "measurements"
ORDER = ["ts", "facility_code"]
FIELDS = (
    "seq",
    "facility_code",
    "facility_name",
    "timestamp",
    "state",
    "fuel_list",
    "power_value",
    "emission_value",
    "price_per_mwh",
    "demand_mw",
    "lat",
    "lng",
    "unit",
    "sent_mono_ns",
    "slot_mono_ns",
)


def publish_sequence(rows: DataFrame, order=ORDER, first: int = 1, slices: int | None = None) -> DataFrame:
    """Number the rows in publish order, from ``first``."""
    numbered = number_rows(rows, list(order), name="seq", slices=slices)
    return numbered.withColumn("seq", F.col("seq") + (first - 1))


def replay_schedule(numbered: DataFrame, start_ns: int = 0, tick_ms: int = TICK_MS) -> DataFrame:
    """Planned send time of each row: one tick per sequence number."""
    slot = F.lit(start_ns) + F.col("seq") * (tick_ms * 1_000_000)
    return numbered.withColumn("slot_mono_ns", slot)


def with_timestamp(rows: DataFrame, ts: str = "ts", zone: str = GRID_ZONE) -> DataFrame:
    """Add the ``timestamp`` text of the message: ISO on the zone's clock, with its offset."""
    return rows.withColumn("timestamp", iso_text(F.col(ts), zone))


def stamp_sent(rows: DataFrame, name: str = "sent_mono_ns") -> DataFrame:
    """Set the time of sending, for the moment a batch of messages goes out."""
    return rows.withColumn(name, F.unix_micros(F.current_timestamp()) * 1000)


def after_cursor(rows: DataFrame, last_ts: Column | None, last_code: str = "", date: str = "event_date") -> DataFrame:
    """Rows strictly after (time, facility) of the last published one; all if unset.

    The plain comparison on time comes first so that the scan can use it. A table
    partitioned by day in the column ``date`` is read from that day on.
    """
    if last_ts is None:
        return rows
    after = (F.col("ts") > last_ts) | (F.col("facility_code") > last_code)
    later = rows.filter((F.col("ts") >= last_ts) & after)
    return later.filter(F.col(date) >= F.to_date(last_ts)) if date in rows.columns else later


def publish_messages(rows: DataFrame, topic_root: str = TOPIC_ROOT) -> DataFrame:
    """``topic`` and JSON ``body``; missing values are written as null."""
    unit = F.create_map(*(F.lit(x) for pair in METRIC_UNIT.items() for x in pair))
    full = rows.withColumn("unit", unit)
    payload = F.struct(*(F.col(c) for c in FIELDS if c in full.columns))
    return full.select(
        "seq",
        F.format_string("%s/%s", F.lit(topic_root), "facility_code").alias("topic"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("body"),
    )
