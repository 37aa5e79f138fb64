"""The driver's tables seen as readings, messages and captured deliveries.

Column expressions are written in the SQL that Spark and DuckDB share, so both
sides of a check start from the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import round_columns
from ..functions.times import wall_micros

STATE = (
    "case user_id % 8 when 0 then 'NSW' when 1 then 'QLD' when 2 then 'VIC' when 3 then 'SA' "
    "when 4 then 'TAS' when 5 then 'WA' when 6 then 'NT' else 'ACT' end"
)
FUEL = (
    "case user_id % 7 when 0 then '[\"Solar\"]' when 1 then '[\"Wind\", \"Solar\"]' "
    "when 2 then '[\"Gas\"]' when 3 then '[\"Black Coal\"]' when 4 then '[\"Landfill Gas\"]' "
    "when 5 then '[\"Hydro\"]' else '[\"Battery\"]' end"
)
# One facility per user; errors carry no power, so there are gaps and negatives.
READING = {
    "facility_code": "concat('F', user_id)",
    "ts": "ts",
    "power_value": "case when event_type = 'error' then null else value - 50 end",
    "emission_value": "case when event_type in ('error', 'signup') then null else value * 0.5 - 20 end",
    "price_per_mwh": "value - 30",
    "demand_mw": "case when event_type = 'view' then null else value * 10 end",
    "event_id": "event_id",
}
# Latitudes and longitudes in exact quarters of a degree.
MESSAGE = {
    "arrival_seq": "event_id",
    "facility_code": "concat('F', user_id)",
    "facility_name": "concat('Station ', user_id)",
    "lat": "cast(user_id * -0.25 as double)",
    "lng": "cast(110 + user_id * 0.25 as double)",
    "timestamp": "cast(event_id as {text})",
    "power_value": "value - 50",
    "emission_value": "value * 0.5",
    "price_per_mwh": "value - 30",
    "demand_mw": "value * 10",
    "state": STATE,
    "fuel_list": FUEL,
    "topic": "concat('site/', event_type, '/', user_id)",
}
_ROUNDED = ("power_value", "emission_value", "price_per_mwh", "demand_mw")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*(f"{sql} as {name}" for name, sql in READING.items()))


def readings_sql() -> str:
    return "select " + ", ".join(f"{sql} as {name}" for name, sql in READING.items()) + " from events"


def as_messages(events: DataFrame) -> DataFrame:
    """Normalized messages of the events; also on a streaming frame."""
    out = events.selectExpr(
        *(f"{sql.format(text='string')} as {name}" for name, sql in MESSAGE.items()), "ts"
    )
    out = round_columns(out, _ROUNDED)
    return out.withColumn("received_us", wall_micros(F.col("ts"))).withColumnRenamed("ts", "received_at")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


def messages_sql() -> str:
    parts = []
    for name, sql in MESSAGE.items():
        expr = sql.format(text="varchar")
        parts.append(f"cast(printf('%.2f', {expr}) as double) as {name}" if name in _ROUNDED else f"{expr} as {name}")
    return "select " + ", ".join(parts) + ", ts as received_at, epoch_us(ts) as received_us from events"


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured deliveries: errors carry no sender clock, every 1000th number is skipped."""
    events = table(spark, sf_dir, "events")
    arrival_ns = wall_micros(F.col("ts")) * 1000
    sent = arrival_ns + F.col("event_id") % 7 * 1_000_000_000
    return events.select(
        F.concat(F.lit("site/"), "event_type").alias("topic"),
        F.col("event_id").alias("arrival_seq"),
        arrival_ns.alias("arrival_ns"),
        (F.col("event_id") + F.floor(F.col("event_id") / 1000)).alias("seq"),
        F.when(F.col("event_type") != "error", sent).alias("sent_mono_ns"),
    )


CAPTURED_SQL = """select concat('site/', event_type) as topic, event_id as arrival_seq,
  epoch_us(ts) * 1000 as arrival_ns, event_id + event_id // 1000 as seq,
  case when event_type <> 'error' then epoch_us(ts) * 1000 + event_id % 7 * 1000000000 end as sent_mono_ns
  from events"""


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message bodies as delivered, with all kinds of defects."""
    return as_raw(table(spark, sf_dir, "events"))


def as_raw(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    payload = F.struct(
        eid.alias("seq"),
        F.when(eid % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" F"), "user_id")).alias("facility_code"),
        F.when(eid % 3 == 0, F.lit("")).when(eid % 3 == 1, F.concat(F.lit("Zürich "), "user_id")).alias("facility_name"),
        F.when(eid % 13 == 0, F.lit("abc")).otherwise((F.col("user_id") * -0.25).cast("string")).alias("lat"),
        (F.col("user_id") * 0.25).alias("lng"),
        F.when(F.col("event_type") != "error", F.col("value") - 50).alias("power_value"),
        F.when(F.col("event_type") == "signup", F.lit("1_000")).otherwise(F.col("value").cast("string")).alias("emission_value"),
        F.when(F.col("event_type") == "view", F.lit("")).alias("price_per_mwh"),
        F.expr(f"case when user_id % 5 = 0 then null else {STATE} end").alias("state"),
        F.expr(FUEL).alias("fuel_list"),
    )
    body = F.when(eid % 17 == 0, F.lit("{broken")).when(eid % 19 == 0, F.lit("[1, 2]"))
    return events.select(
        eid.alias("arrival_seq"),
        F.concat(F.lit("site/"), "event_type", F.lit("/"), "user_id").alias("topic"),
        body.otherwise(F.to_json(payload)).alias("body"),
    )


RAW_SQL = f"""select *, case when event_id % 17 = 0 then 'invalid_json' when event_id % 19 = 0 then 'not_object'
  when event_id % 11 = 0 then 'no_facility_code' when event_id % 13 = 0 then 'bad_lat'
  when event_type = 'error' then 'bad_power_value' end as reason,
  case when user_id % 5 = 0 then 'Unknown Region' else {STATE} end as state, {FUEL} as fuel_list from events"""
