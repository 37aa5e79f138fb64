"""Message sources: topic filters, decoding, normalization, quarantine."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.frames import compute_once, round_columns
from ..functions.scalars import default_if_empty, tolerant_float
from ..operators import ordered

UNKNOWN_REGION = "Unknown Region"
UNKNOWN_FUEL = "Unknown"
JSON_BLANKS = " \t\r\n"
# White space of all scripts, at the start or the end.
BLANK_ENDS = r"(?U)^\s+|\s+$"


def topic_regex(topic_filter: str) -> str:
    """Topic filter to a regular expression: ``+`` is one level, a final ``#`` any number."""
    levels = topic_filter.split("/")
    tail = ""
    if levels[-1] == "#":
        levels.pop()
        tail = "(/.*)?" if levels else ".*"
    body = "/".join("[^/]*" if level == "+" else re.escape(level) for level in levels)
    return f"^{body}{tail}$"


def matching_topics(messages: DataFrame, topic_filter: str, topic: str = "topic") -> DataFrame:
    return messages.filter(F.col(topic).rlike(topic_regex(topic_filter)))


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
    """Unbounded source over files as they land."""
    reader = spark.readStream.schema(schema).format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def stream_kafka(spark: SparkSession, servers: str, topic_pattern: str, per_trigger: int = 1_000_000) -> DataFrame:
    """Unbounded source over Kafka; needs the Kafka package on the class path.

    The message topic travels in the record key. The broker timestamp is the
    time of receipt. The offset orders one partition only; ``number_arrivals``
    (or ``committed.write_arrivals`` on the stream) makes a total order of
    (received_at, partition, offset).
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topic_pattern)
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
    return raw.select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("body"),
        F.col("timestamp").alias("received_at"),
        "partition",
        "offset",
    )


ARRIVAL = ("received_at", "partition", "offset")


def number_arrivals(raw: DataFrame, order: Sequence[str] = ARRIVAL, name: str = "arrival_seq", first: int = 0) -> DataFrame:
    """Dense arrival numbers from ``first`` on over all partitions of a source.

    Offsets are unique in a partition, so the order is total; it puts a message with
    no time first. Rows are numbered slice by slice, not in one task.
    """
    numbered = ordered.number_rows(raw, order, name=name)
    return numbered.withColumn(name, F.col(name) + (first - 1))


def decode_messages(raw: DataFrame, body: str = "body") -> DataFrame:
    """Add the parsed ``payload`` and, where the body is no JSON object, ``decode_error``.

    The parser stops at the end of the first value and would let text behind it
    pass. So the body is read as the first of two elements of an array: what may
    follow the object then breaks the array or changes its number of elements.
    """
    listed = F.concat(F.lit("["), F.col(body), F.lit(",{}]"))
    schema = f"array<struct<{schemas.MESSAGE.replace(' string', ':string')}>>"
    options = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false"}
    parsed = compute_once(raw, {"_listed": F.from_json(listed, schema, options)})
    text = F.ltrim(F.col(body), F.lit(JSON_BLANKS))
    whole = F.coalesce((F.size("_listed") == 2) & text.startswith("{"), F.lit(False))
    error = F.when(text.startswith("["), F.lit("not_object")).when(~whole, F.lit("invalid_json"))
    one = parsed.withColumns({"payload": F.when(whole, F.get("_listed", F.lit(0))), "decode_error": error})
    return one.drop("_listed")


def captured_messages(raw: DataFrame, body: str = "body", received_ns: str = "arrival_ns") -> DataFrame:
    """Messages as the cadence check takes them: ``topic, arrival_seq, arrival_ns, seq, sent_mono_ns``.

    Every delivery counts as an arrival, also one whose body is no JSON; numbers
    that cannot be read are NULL.
    """
    p = F.col("payload")
    whole = lambda c: F.coalesce(p[c].try_cast("bigint"), tolerant_float(p[c]).try_cast("bigint"))
    read = compute_once(
        decode_messages(raw, body), {"_seq": whole("seq"), "_sent": whole("sent_mono_ns")}, ["topic", "arrival_seq", received_ns]
    )
    return read.select("topic", "arrival_seq", received_ns, F.col("_seq").alias("seq"), F.col("_sent").alias("sent_mono_ns"))


def stamp_receipt(raw: DataFrame, received: str = "received_at") -> DataFrame:
    """Set the time of receipt where the source gives none."""
    if received not in raw.columns:
        return raw.withColumn(received, F.current_timestamp())
    return raw.withColumn(received, F.coalesce(received, F.current_timestamp()))


NUMBERS = ("lat", "lng", *schemas.METRICS)


def check_messages(raw: DataFrame, body: str = "body") -> DataFrame:
    """Add the payload, its numbers, its trimmed code, and ``reason``: the first
    thing that keeps the message from being shown, or NULL."""
    p = F.col("payload")
    code = F.regexp_replace(F.coalesce(p["facility_code"], F.lit("")), BLANK_ENDS, "")
    checked = compute_once(
        decode_messages(raw, body),
        {"facility_code": code, **{c: tolerant_float(p[c]) for c in NUMBERS}},
    )
    reason = (
        F.when(F.col("decode_error").isNotNull(), F.col("decode_error"))
        .when(F.col("facility_code") == "", F.lit("no_facility_code"))
        .when(F.col("lat").isNull(), F.lit("bad_lat"))
        .when(F.col("lng").isNull(), F.lit("bad_lng"))
        .when(F.col("power_value").isNull(), F.lit("bad_power_value"))
    )
    return checked.withColumn("reason", reason)


def normalize_checked(checked: DataFrame, kept: Sequence[str], topic: str = "topic") -> DataFrame:
    """The typed and defaulted form of messages from ``check_messages``, with ``kept`` columns."""
    p, code = F.col("payload"), F.col("facility_code")
    named = checked.select(
        *kept,
        code,
        default_if_empty(p["facility_name"], code).alias("facility_name"),
        "lat",
        "lng",
        F.coalesce(p["timestamp"], F.lit("")).alias("timestamp"),
        *(F.coalesce(m, F.lit(0.0)).alias(m) for m in schemas.METRICS),
        default_if_empty(p["state"], F.lit(UNKNOWN_REGION)).alias("state"),
        default_if_empty(p["fuel_list"], F.lit(UNKNOWN_FUEL)).alias("fuel_list"),
        F.col(topic).alias("topic"),
    )
    return round_columns(named, schemas.METRICS)


def normalize_messages(raw: DataFrame, body: str = "body", topic: str = "topic") -> DataFrame:
    """Checked, typed and defaulted messages; works on batch and streaming input.

    Columns of the input other than the body are kept.
    """
    kept = [c for c in raw.columns if c not in (body, topic)]
    return normalize_checked(check_messages(raw, body).filter(F.col("reason").isNull()), kept, topic)


def quarantined_messages(raw: DataFrame, body: str = "body") -> DataFrame:
    """The messages ``normalize_messages`` leaves out, with the reason."""
    checked = check_messages(raw, body).filter(F.col("reason").isNotNull())
    return checked.select(*raw.columns, "reason")
