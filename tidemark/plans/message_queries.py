"""Queries over messages: intake, snapshot, KPIs, trend, cadence, and their streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import wall_micros
from ..operators import cadence, histogram, publish, snapshot, trend
from ..schemas import METRIC_UNIT
from ..session import new_folder
from ..sources import messages as intake
from ..streaming import committed, live
from ..streaming.versions import read_table
from .bindings import (
    CAPTURED_SQL,
    RAW_SQL,
    as_messages,
    as_raw,
    captured,
    messages,
    messages_sql,
    raw_messages,
    table,
)
from .registry import query

RAW = f"with raw as ({RAW_SQL}) "
MESSAGES = f"with m as ({messages_sql()}) "
LATEST = MESSAGES.rstrip() + (
    ", s as (select * from m qualify row_number() over (partition by facility_code order by arrival_seq desc) = 1) "
)
CAPTURED = f"with c as ({CAPTURED_SQL}) "
SPAN_US = 6 * 3600 * 1_000_000

# -- intake ----------------------------------------------------------------------

TOPIC_FILTERS = ("site/click/#", "site/+/7")


@query(
    "topic_filter",
    """select event_id, t as topic, f as topic_filter from
    (select event_id, concat('site/', event_type, '/', user_id) as t from events),
    (values ('site/click/#', '^site/click(/.*)?$'), ('site/+/7', '^site/[^/]*/7$')) x(f, r)
    where regexp_matches(t, r)""",
)
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = raw_messages(spark, sf_dir).select(F.col("arrival_seq").alias("event_id"), "topic")
    parts = [intake.matching_topics(topics, f).withColumn("topic_filter", F.lit(f)) for f in TOPIC_FILTERS]
    return parts[0].unionByName(parts[1])


@query("message_quarantine", RAW + "select event_id as arrival_seq, reason from raw where reason is not null")
def message_quarantine(spark, sf_dir):
    return intake.quarantined_messages(raw_messages(spark, sf_dir)).select("arrival_seq", "reason")


NORMALIZED_SQL = RAW + """select event_id as arrival_seq, concat('F', user_id) as facility_code,
  case when event_id % 3 = 1 then concat('Zürich ', user_id) else concat('F', user_id) end as facility_name,
  cast(user_id * -0.25 as double) as lat, cast(user_id * 0.25 as double) as lng, round_even(value - 50, 2) as power_value,
  round_even(case when event_type = 'signup' then 1000 else value end, 2) as emission_value, 0.0::double as price_per_mwh,
  0.0::double as demand_mw, '' as "timestamp", state, fuel_list, concat('site/', event_type, '/', user_id) as topic
  from raw where reason is null"""


@query("normalize_messages", NORMALIZED_SQL)
def normalize_messages(spark, sf_dir):
    return intake.normalize_messages(raw_messages(spark, sf_dir))


# -- snapshot --------------------------------------------------------------------

SNAPSHOT_COLUMNS = (
    "arrival_seq", "facility_code", "state", "fuel_list", "power_value", "emission_value", "price_per_mwh", "demand_mw",
)
COLUMNS = ", ".join(SNAPSHOT_COLUMNS)


def _snapshot(spark, sf_dir) -> DataFrame:
    return snapshot.latest_snapshot(messages(spark, sf_dir))


@query("latest_snapshot", LATEST + f"select {COLUMNS} from s")
def latest_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*SNAPSHOT_COLUMNS)


@query("last_n_messages", MESSAGES + f"select {COLUMNS} from m order by arrival_seq desc limit 1000")
def last_n_messages(spark, sf_dir):
    return snapshot.last_messages(messages(spark, sf_dir)).select(*SNAPSHOT_COLUMNS)


@query(
    "latest_message",
    MESSAGES + 'select facility_code, facility_name, state, fuel_list, "timestamp" from m order by arrival_seq desc limit 1',
)
def latest_message(spark, sf_dir):
    fields = [c for c in snapshot.LATEST_FIELDS if c != "received_at"]
    return snapshot.latest_message(messages(spark, sf_dir)).select(*fields)


PARTITIONS = 3
#: Deliveries of three partitions, with times that repeat within and between them.
OFFSETS_SQL = f"""select *, date_trunc('hour', received_at) as hour, arrival_seq % {PARTITIONS} as part,
  arrival_seq // {PARTITIONS} as off from m"""


def _partitioned(messages: DataFrame) -> DataFrame:
    """Messages as a source of several partitions gives them: an offset orders its own partition only."""
    return messages.select(
        *(c for c in messages.columns if c not in ("arrival_seq", "received_at")),
        F.col("arrival_seq").alias("message"),
        F.date_trunc("hour", "received_at").alias("received_at"),
        (F.col("arrival_seq") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"arrival_seq div {PARTITIONS}").alias("offset"),
    )


@query(
    "partition_order",
    MESSAGES + f"select arrival_seq as message, row_number() over (order by hour, part, off) - 1 as arrival_seq from ({OFFSETS_SQL})",
)
def partition_order(spark, sf_dir):
    return intake.number_arrivals(_partitioned(messages(spark, sf_dir))).select("message", "arrival_seq")


@query(
    "partition_snapshot",
    MESSAGES
    + f"""select arrival_seq as message, facility_code, power_value from ({OFFSETS_SQL})
    qualify row_number() over (partition by facility_code order by hour desc, part desc, off desc) = 1""",
)
def partition_snapshot(spark, sf_dir):
    """Latest per facility by time, partition and offset, without numbering first."""
    rows = _partitioned(messages(spark, sf_dir))
    return snapshot.latest_snapshot(rows, arrival=intake.ARRIVAL).select("message", "facility_code", "power_value")


@query("snapshot_filter", LATEST + f"select {COLUMNS} from s where contains(fuel_list, 'Gas') and state = 'VIC'")
def snapshot_filter(spark, sf_dir):
    return snapshot.filter_snapshot(_snapshot(spark, sf_dir), "Gas", "VIC").select(*SNAPSHOT_COLUMNS)


KPI_SQL = """select count(*) as facility_count, round_even(coalesce(sum(power_value), 0), 2) as total_power,
  round_even(coalesce(sum(emission_value), 0), 2) as total_emission,
  round_even(coalesce(quantile_cont(price_per_mwh, 0.5) filter (price_per_mwh > 0), 0), 2) as median_price,
  round_even(coalesce(quantile_cont(demand_mw, 0.5) filter (demand_mw > 0), 0), 2) as median_demand from """


@query("snapshot_kpis", LATEST + KPI_SQL + "s")
def snapshot_kpis(spark, sf_dir):
    return snapshot.snapshot_kpis(_snapshot(spark, sf_dir))


CURRENT = MESSAGES.rstrip() + (
    f", b as (select min(received_us) as start_us, max(received_us) as end_us from m), "
    f"cur as (select m.*, (received_us - start_us) // {SPAN_US} as epoch from m, b "
    f"where (received_us - start_us) // {SPAN_US} = (end_us - start_us) // {SPAN_US}) "
)
STORE = CURRENT.rstrip() + (
    ", store as (select * from cur order by arrival_seq desc limit 1000), shown as (select * from store "
    "qualify row_number() over (partition by facility_code order by arrival_seq desc) = 1) "
)


@query("dashboard_kpis", STORE + KPI_SQL + "shown")
def dashboard_kpis(spark, sf_dir):
    """KPIs as a live view shows them: over the bounded store since the last reset."""
    store = snapshot.last_messages(snapshot.since_reset(messages(spark, sf_dir)))
    return snapshot.store_kpis(snapshot.latest_snapshot(store))


@query(
    "snapshot_preview",
    LATEST
    + """select facility_code, facility_name, state, fuel_list, power_value, emission_value, price_per_mwh,
    demand_mw, "timestamp" from s order by facility_code""",
)
def snapshot_preview(spark, sf_dir):
    return snapshot.preview(_snapshot(spark, sf_dir))


@query(
    "map_points",
    LATEST
    + """select facility_code, lat, lng, power_value as value, 'MW' as unit, 'Power' as label,
    case when contains(fuel_list, 'Solar') or contains(fuel_list, 'Wind') or contains(fuel_list, 'Hydro') then 'green'
      when contains(fuel_list, 'Gas') then 'orange' else 'red' end as colour,
    facility_name || ' | Power: ' || regexp_replace(printf('%.2f', power_value), '0$', '') || ' MW' as tooltip,
    facility_name || chr(10) || 'Facility Code: ' || facility_code || chr(10) || 'Region: ' || state || chr(10)
      || 'Fuel Type: ' || fuel_list || chr(10) || 'Last Payload Time: ' || "timestamp" || chr(10)
      || 'Power Output: ' || regexp_replace(printf('%.2f', power_value), '0$', '') || ' MW' || chr(10)
      || 'CO2 Emissions: ' || regexp_replace(printf('%.2f', emission_value), '0$', '') || ' tCO2e' || chr(10)
      || 'Current Price: ' || regexp_replace(printf('%.2f', price_per_mwh), '0$', '') || ' $/MWh' || chr(10)
      || 'Grid Demand: ' || regexp_replace(printf('%.2f', demand_mw), '0$', '') || ' MW' as detail from s""",
)
def map_points(spark, sf_dir):
    return snapshot.map_points(_snapshot(spark, sf_dir))


@query(
    "snapshot_fingerprint",
    LATEST
    + """select 'power_value' as mode, 'All' as fuel, 'All' as region, count(*) as markers,
    cast(sum(cast(('0x' || substr(md5(concat_ws('|', facility_code, printf('%.5f', lat), printf('%.5f', lng), state,
      fuel_list, facility_name)), 1, 15)) as bigint)) as varchar) as digest from s""",
)
def snapshot_fingerprint(spark, sf_dir):
    return snapshot.fingerprint(_snapshot(spark, sf_dir))


@query("reset_epoch", CURRENT + "select arrival_seq, epoch from cur")
def reset_epoch(spark, sf_dir):
    return snapshot.since_reset(messages(spark, sf_dir)).select("arrival_seq", "epoch")


STATUS_SQL = (
    STORE
    + f"""select (select count(*) from m) as total_messages, count(*) as messages_since_reset,
    least(count(*), 1000) as store_size, max(received_us) as last_update_us,
    (select start_us from b) + max(epoch) * {SPAN_US} as last_reset_us,
    (max(received_us) - ((select start_us from b) + max(epoch) * {SPAN_US})) / 1e6 as seconds_since_reset,
    (select count(*) from shown) as facilities,
    (select count(*) from shown where contains(fuel_list, 'Gas')) as facilities_shown from cur"""
)


@query("stream_status", STATUS_SQL)
def stream_status(spark, sf_dir):
    return snapshot.stream_status(messages(spark, sf_dir), fuel="Gas")


# -- trend -----------------------------------------------------------------------

TAIL = MESSAGES.rstrip() + (
    ", t0 as (select * from m order by arrival_seq desc limit 120), "
    "t as (select *, row_number() over (order by arrival_seq) - 1 as place from t0), "
    "b as (select count(*) as n, least(min(power_value), min(emission_value), min(price_per_mwh), min(demand_mw)) as lo, "
    "greatest(max(power_value), max(emission_value), max(price_per_mwh), max(demand_mw)) as hi from t) "
)


@query(
    "trend_frame",
    MESSAGES
    + "select arrival_seq, received_us, facility_code, state, power_value, emission_value, price_per_mwh, demand_mw from m",
)
def trend_frame(spark, sf_dir):
    return trend.trend_frame(messages(spark, sf_dir), "received_us")


@query(
    "trend_scaled",
    TAIL
    + """, u as (unpivot (select place, power_value, emission_value, price_per_mwh, demand_mw from t)
      on power_value, emission_value, price_per_mwh, demand_mw into name metric value value)
    select metric, place::integer as place, round_even(place / (n - 1), 9) as x, value, round_even((value - lo) / (hi - lo), 9) as y from u, b""",
)
def trend_scaled(spark, sf_dir):
    out = trend.trend_scaled(trend.trend_frame(messages(spark, sf_dir)))
    return out.withColumns({c: F.bround(c, 9) for c in ("x", "y")})


@query(
    "trend_ticks",
    TAIL
    + """select 'y' as axis, k as place, round_even(hi - (hi - lo) * k / 4, 6) as value,
      cast(cast(round_even(hi - (hi - lo) * k / 4, 0) as bigint) as varchar) as label
      from b, (select unnest([0, 1, 2, 3, 4]) as k)
    union all select 'x', place, null, strftime(received_at, '%H:%M:%S') from t, b
      where place in (0, n // 2, n - 1)""",
)
def trend_ticks(spark, sf_dir):
    out = trend.trend_ticks(trend.trend_frame(messages(spark, sf_dir)))
    return out.withColumns({"value": F.bround("value", 6), "place": F.col("place").cast("bigint")})


# -- cadence ---------------------------------------------------------------------

EXPECTED_S, TOLERANCE_S = 26.0, 20.0
GLOBAL_D = "select arrival_seq, topic, arrival_ns - lag(arrival_ns) over (order by arrival_seq) as delta_ns from c"
SENDER_D = (
    "select arrival_seq, topic, sent_mono_ns - lag(sent_mono_ns) over (order by arrival_seq) as delta_ns "
    "from c where sent_mono_ns is not null"
)
TOPIC_D = (
    "select arrival_seq, topic, arrival_ns - lag(arrival_ns) over (partition by topic order by arrival_seq) "
    "as delta_ns from c"
)


@query("global_deltas", CAPTURED + f"select * from ({GLOBAL_D}) where delta_ns is not null")
def global_deltas(spark, sf_dir):
    return cadence.global_deltas(captured(spark, sf_dir))


@query("sender_deltas", CAPTURED + f"select * from ({SENDER_D}) where delta_ns is not null")
def sender_deltas(spark, sf_dir):
    return cadence.sender_deltas(captured(spark, sf_dir))


@query("topic_deltas", CAPTURED + f"select * from ({TOPIC_D}) where delta_ns is not null")
def topic_deltas(spark, sf_dir):
    return cadence.topic_deltas(captured(spark, sf_dir))


@query(
    "sequence_gaps",
    CAPTURED
    + """select * from (select arrival_seq, seq, lag(seq) over (order by arrival_seq) as previous_seq from c)
    where seq <> previous_seq + 1""",
)
def sequence_gaps(spark, sf_dir):
    return cadence.sequence_gaps(captured(spark, sf_dir))


DELTAS = CAPTURED.rstrip() + (
    f", d as (select 'sender' as scope, null::varchar as topic, delta_ns from ({SENDER_D}) union all "
    f"select 'arrival', null, delta_ns from ({GLOBAL_D}) union all select 'topic', topic, delta_ns from ({TOPIC_D})), "
    "k as (select * from d where delta_ns is not null) "
)
_STATS = ("mean_s", "min_s", "max_s", "p50_s", "p90_s", "p95_s", "p99_s", "within_pct")


_REPORT_SQL = (
    "select scope, topic, count(*) as n, "
    + ", ".join(
        f"round_even({expr}, 6) as {name}"
        for name, expr in zip(
            _STATS,
            (
                "sum(delta_ns)::double / count(*) / 1e9",
                "min(delta_ns) / 1e9",
                "max(delta_ns) / 1e9",
                *(f"quantile_cont(delta_ns, {q}) / 1e9" for q in (0.5, 0.9, 0.95, 0.99)),
                f"count_if(delta_ns between {int((EXPECTED_S - TOLERANCE_S) * 1e9)} and "
                f"{int((EXPECTED_S + TOLERANCE_S) * 1e9)}) * 100.0::double / count(*)",
            ),
        )
    )
    + " from k group by scope, topic"
)


@query("cadence_report", DELTAS + _REPORT_SQL)
def cadence_report(spark, sf_dir):
    out = cadence.cadence_report(captured(spark, sf_dir), EXPECTED_S, TOLERANCE_S)
    return out.withColumns({c: F.bround(c, 6) for c in _STATS})


SAMPLE_S = 10 * 24 * 3600


@query(
    "cadence_sample",
    DELTAS.replace(
        CAPTURED.rstrip(),
        CAPTURED.replace("with c as", "with c0 as").rstrip()
        + f", c as (select * from c0 where arrival_ns < (select min(arrival_ns) from c0) + {SAMPLE_S * 1_000_000_000})",
    )
    + _REPORT_SQL,
)
def cadence_sample(spark, sf_dir):
    """The report over the start of the capture, as long as a live check runs; here ten days."""
    out = cadence.cadence_report(captured(spark, sf_dir), EXPECTED_S, TOLERANCE_S, seconds=SAMPLE_S)
    return out.withColumns({c: F.bround(c, 6) for c in _STATS})


@query(
    "cadence_verdict",
    DELTAS
    + f"""select 'sender' as scope, count(*) as n, count_if(delta_ns between 6000000000 and 46000000000)::bigint as within,
    case when count_if(delta_ns between 6000000000 and 46000000000) >= 0.95 * count(*) then 'PASS' else 'FAIL' end as verdict
    from k where scope = 'sender'""",
)
def cadence_verdict(spark, sf_dir):
    return cadence.cadence_verdict(captured(spark, sf_dir), EXPECTED_S, TOLERANCE_S)


_LENGTH = "greatest(length(bin(abs({x}))) - 8, 0)"
_LOW = "((abs({x}) >> {l}) << {l}) * (case when {x} < 0 then -1 else 1 end)"
_HALF = "((1::bigint << {l}) // 2) * (case when {x} < 0 then -1 else 1 end)"


@query(
    "cadence_by_day",
    CAPTURED.rstrip()
    + f""", g as (select topic, arrival_ns - lag(arrival_ns) over (partition by topic
      order by make_timestamp(arrival_ns // 1000)::date, arrival_seq) as x from c),
    b as (select topic, {_LOW.format(x="x", l=_LENGTH.format(x="x"))} as bucket, count(*) as n from g where x is not null group by all),
    r as (select *, sum(n) over (partition by topic order by bucket) as fin, sum(n) over (partition by topic) as total from b),
    p as (select topic, sum(n)::bigint as n, """
    + ", ".join(f"min(bucket) filter (fin > floor((total - 1) * {q}::double)) as {name}" for name, q in cadence.QUANTILES.items())
    + " from r group by topic) select topic, n, "
    + ", ".join(f"({c} + {_HALF.format(x=c, l=_LENGTH.format(x=c))})::bigint as {c}" for c in cadence.QUANTILES)
    + " from p",
)
def cadence_by_day(spark, sf_dir):
    """Gaps per topic from summaries by day; the last day comes later, as a day of its own."""
    path = new_folder(spark, "cadence_by_day")
    day = F.to_date(F.timestamp_micros(F.expr("arrival_ns div 1000")))
    rows = captured(spark, sf_dir).withColumn(histogram.DAY, day)
    last = rows.agg(F.max(histogram.DAY)).scalar()
    for part in (rows.filter(F.col(histogram.DAY) < last), rows.filter(F.col(histogram.DAY) == last)):
        histogram.write_days(part, path)
    return histogram.quantiles(histogram.read_counts(spark, path), cadence.QUANTILES, ["topic"])


@query(
    "captured_messages",
    RAW
    + """select concat('site/', event_type, '/', user_id) as topic, event_id as arrival_seq, epoch_us(ts) * 1000 as arrival_ns,
    case when event_id % 17 = 0 or event_id % 19 = 0 then null else event_id end as seq, null::bigint as sent_mono_ns
    from raw""",
)
def captured_messages(spark, sf_dir):
    """Broken bodies count as arrivals."""
    events = table(spark, sf_dir, "events")
    raw = as_raw(events).join(events.select(F.col("event_id").alias("arrival_seq"), "ts"), "arrival_seq")
    return intake.captured_messages(raw.withColumn("arrival_ns", wall_micros(F.col("ts")) * 1000))


@query(
    "publish_roundtrip",
    """with p as (select event_id as seq, concat('measurements/F', user_id) as topic, concat('F', user_id) as facility_code,
      strftime(ts + interval 11 hour, '%Y-%m-%dT%H:%M:%S') || '+11:00' as "timestamp", value as power_value,
      5000000000 + event_id * 100000000 as slot_mono_ns from (select * replace (date_trunc('second', ts) as ts) from events))
    select *, true as stamped from p""",
)
def publish_roundtrip(spark, sf_dir):
    """Rows are sent by a checkpointed stream, captured, and read back."""
    base = new_folder(spark, "publish_roundtrip")
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("F"), "user_id").alias("facility_code"),
        F.timestamp_micros(wall_micros(F.date_trunc("second", "ts").cast("timestamp_ntz"))).alias("ts"),
        F.col("value").alias("power_value"),
    )
    numbered = publish.replay_schedule(publish.with_timestamp(rows), start_ns=5_000_000_000)
    numbered.write.parquet(f"{base}/rows")
    stream = intake.stream_files(spark, f"{base}/rows", numbered.schema)
    for _ in range(2):  # the second run finds nothing new
        live.publish_rows(stream, f"{base}/sent", f"{base}/checkpoint")
    sent = spark.read.schema("seq bigint, topic string, body string").json(f"{base}/sent")
    raw = sent.select("topic", "body", F.col("seq").alias("arrival_seq"), (F.col("seq") * 100).alias("arrival_ns"))
    clocks = intake.captured_messages(raw).select("arrival_seq", F.col("sent_mono_ns").isNotNull().alias("stamped"))
    read = intake.decode_messages(raw).select(
        "arrival_seq",
        F.col("payload.seq").cast("bigint").alias("seq"),
        "topic",
        "payload.facility_code",
        "payload.timestamp",
        F.col("payload.power_value").cast("double").alias("power_value"),
        F.col("payload.slot_mono_ns").cast("bigint").alias("slot_mono_ns"),
    )
    return read.join(clocks, "arrival_seq").drop("arrival_seq")


_SENT = ("facility_code", "facility_name", "state", "fuel_list", "power_value", "emission_value", "price_per_mwh", "demand_mw", "lat", "lng")


@query(
    "publish_fields",
    MESSAGES
    + f"""select arrival_seq as seq, concat('measurements/', facility_code) as topic, {", ".join(_SENT)},
    strftime(date_trunc('second', received_at) + interval 11 hour, '%Y-%m-%dT%H:%M:%S') || '+11:00' as "timestamp",
    {", ".join(f"'{u}' as {c}_unit" for c, u in METRIC_UNIT.items())},
    5000000000 + arrival_seq * 100000000 as slot_mono_ns, 5000000007 + arrival_seq * 100000000 as sent_mono_ns,
    '{",".join(publish.FIELDS)}' as fields from m""",
)
def publish_fields(spark, sf_dir):
    """Every field of a message, read back from its body, and the order of the fields in it."""
    second = F.expr("received_us - received_us % 1000000")
    rows = messages(spark, sf_dir).select(F.col("arrival_seq").alias("seq"), *_SENT, F.timestamp_micros(second).alias("ts"))
    due = publish.replay_schedule(publish.with_timestamp(rows), start_ns=5_000_000_000)
    sent = publish.publish_messages(due.withColumn("sent_mono_ns", F.col("slot_mono_ns") + 7))
    kinds = {c: "double" for c in _SENT[4:]} | {c: "bigint" for c in ("seq", "sent_mono_ns", "slot_mono_ns")} | {"unit": "map<string,string>"}
    read = sent.withColumn("p", F.from_json("body", ", ".join(f"{c} {kinds.get(c, 'string')}" for c in publish.FIELDS)))
    return read.select(
        "topic",
        *(f"p.{c}" for c in publish.FIELDS if c != "unit"),
        *(F.col("p.unit")[c].alias(f"{c}_unit") for c in METRIC_UNIT),
        F.array_join(F.json_object_keys("body"), ",").alias("fields"),
    )


# -- streams ---------------------------------------------------------------------


def _events_stream(spark, sf_dir) -> DataFrame:
    # A pattern, as a plain path would have to be a folder.
    schema = table(spark, sf_dir, "events").schema
    return intake.stream_files(spark, f"{sf_dir}/events.parquet*", schema)


def _message_stream(spark, sf_dir) -> DataFrame:
    return as_messages(_events_stream(spark, sf_dir))


@query("stream_normalize", NORMALIZED_SQL)
def stream_normalize(spark, sf_dir):
    base = new_folder(spark, "stream_normalize")
    stream = intake.normalize_messages(as_raw(_events_stream(spark, sf_dir)))
    live.append_table(stream, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table")


@query("stream_snapshot", LATEST + f"select {COLUMNS} from s")
def stream_snapshot(spark, sf_dir):
    base = new_folder(spark, "stream_snapshot")
    committed.write_snapshot_log(_message_stream(spark, sf_dir), f"{base}/log", f"{base}/checkpoint")
    return committed.read_snapshot_log(spark, f"{base}/log").select(*SNAPSHOT_COLUMNS)


def _landed(spark, sf_dir, base: str, parts: int) -> Iterator[DataFrame]:
    """The events land in so many parts, by event number; after each the stream, to be run as one micro-batch.

    A part has many files, so that neither its write nor its batch is one task's work.
    """
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    for part in range(parts):
        low, high = part * (last + 1) // parts, (part + 1) * (last + 1) // parts
        chunk = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        chunk.repartition("event_id").write.mode("append").parquet(f"{base}/landed")
        yield intake.stream_files(spark, f"{base}/landed", events.schema)


@query(
    "stream_arrivals",
    MESSAGES
    + f"""select arrival_seq as message, row_number() over (order by batch, hour, part, off) - 1 as arrival_seq from (
    select *, (select count(*) from (values (1), (2)) x(i) where arrival_seq >= i * (last + 1) // 3) as batch
    from ({OFFSETS_SQL}), (select max(arrival_seq) as last from m))""",
)
def stream_arrivals(spark, sf_dir):
    """Numbers go on from one micro-batch to the next; the second run of each finds nothing new."""
    base = new_folder(spark, "stream_arrivals")
    for stream in _landed(spark, sf_dir, base, 3):
        for _ in range(2):
            committed.write_arrivals(_partitioned(as_messages(stream)), f"{base}/table", f"{base}/checkpoint")
    return read_table(spark, f"{base}/table", "arrivals").select("message", "arrival_seq")


@query("stream_quarantine", RAW + "select event_id as arrival_seq, reason from raw")
def stream_quarantine(spark, sf_dir):
    """Every message is in one of the two tables that one stream writes."""
    base = new_folder(spark, "stream_quarantine")
    for stream in _landed(spark, sf_dir, base, 2):
        committed.write_checked(as_raw(stream), f"{base}/tables", f"{base}/checkpoint")
    good = read_table(spark, f"{base}/tables", "messages").select("arrival_seq", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(committed.read_quarantine(spark, f"{base}/tables").select("arrival_seq", "reason"))


@query("stream_kpis", LATEST + KPI_SQL + "s")
def stream_kpis(spark, sf_dir):
    base = new_folder(spark, "stream_kpis")
    live.write_kpis(_message_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint")
    return live.read_newest(spark, f"{base}/out/kpis")


@query("stream_last_n", MESSAGES + f"select {COLUMNS} from m order by arrival_seq desc limit 1000")
def stream_last_n(spark, sf_dir):
    base = new_folder(spark, "stream_last_n")
    live.write_last_n(_message_stream(spark, sf_dir), f"{base}/store", f"{base}/checkpoint")
    return live.read_newest(spark, f"{base}/store").select(*SNAPSHOT_COLUMNS)


def _dashboard(spark, sf_dir) -> str:
    """The live view after the events have come in four parts, one micro-batch each."""
    base = new_folder(spark, "stream_dashboard")
    for stream in _landed(spark, sf_dir, base, 4):
        live.write_view(as_messages(stream), f"{base}/view", f"{base}/checkpoint")
    return f"{base}/view"


@query("stream_dashboard_kpis", STORE + KPI_SQL + "shown")
def stream_dashboard_kpis(spark, sf_dir):
    return live.read_view(spark, _dashboard(spark, sf_dir), "kpis")


@query("stream_dashboard_store", STORE + f"select {COLUMNS} from store")
def stream_dashboard_store(spark, sf_dir):
    return live.read_view(spark, _dashboard(spark, sf_dir), "store").select(*SNAPSHOT_COLUMNS)


@query("stream_dashboard_status", STATUS_SQL)
def stream_dashboard_status(spark, sf_dir):
    return live.view_status(spark, _dashboard(spark, sf_dir), fuel="Gas")


#: Refreshes, and hours between resets, of the view that counts from its last reset.
REFRESHES, REFRESH_HOURS = 7, 200.0
DUE = f"now - reset_us >= {int(REFRESH_HOURS * 3_600_000_000)}"
REFRESHED = MESSAGES.replace("with", "with recursive", 1).rstrip() + f"""
, p as (select *, (select count(*) from range(1, {REFRESHES}) x(i) where arrival_seq >= i * (last + 1) // {REFRESHES}) as batch
  from m, (select max(arrival_seq) as last from m)),
ends as (select batch, max(max(received_us)) over (order by batch) as now from p group by batch),
clock as (select -1 as batch, min(received_us) as reset_us, -1 as cleared, 0 as resets from p where batch = 0
  union all select e.batch, case when {DUE} then now else reset_us end, case when {DUE} then e.batch else cleared end,
    resets + case when {DUE} then 1 else 0 end
  from clock c join ends e on e.batch = c.batch + 1),
final as (select * from clock order by batch desc limit 1),
since as (select p.* from p, final where p.batch > final.cleared),
store as (select * from since order by arrival_seq desc limit 1000),
shown as (select * from store qualify row_number() over (partition by facility_code order by arrival_seq desc) = 1)
"""


def _refreshed(spark, sf_dir) -> str:
    """A view whose resets count from the last one; it is refreshed after each of seven parts."""
    base = new_folder(spark, "stream_refresh")
    for stream in _landed(spark, sf_dir, base, REFRESHES):
        committed.write_refreshes(as_messages(stream), f"{base}/view", f"{base}/checkpoint", hours=REFRESH_HOURS)
    return f"{base}/view"


@query("stream_refresh_store", REFRESHED + f"select {COLUMNS} from store")
def stream_refresh_store(spark, sf_dir):
    return read_table(spark, _refreshed(spark, sf_dir), "store").select(*SNAPSHOT_COLUMNS)


@query("stream_refresh_kpis", REFRESHED + KPI_SQL + "shown")
def stream_refresh_kpis(spark, sf_dir):
    return committed.refresh_kpis(spark, _refreshed(spark, sf_dir))


@query(
    "stream_refresh_status",
    REFRESHED
    + """select (select count(*) from m) as total_messages, (select count(*) from since) as messages_since_reset,
    resets::bigint as resets, (select max(received_us) from m) as last_update_us, reset_us as last_reset_us,
    ((select max(received_us) from m) - reset_us) / 1e6 as seconds_since_reset,
    (select count(*) from shown) as facilities,
    (select count(*) from shown where contains(fuel_list::varchar, 'Gas')) as facilities_shown from final""",
)
def stream_refresh_status(spark, sf_dir):
    return committed.refresh_status(spark, _refreshed(spark, sf_dir), fuel="Gas")


@query("stream_dedupe", "select distinct event_id // 2 as seq from events")
def stream_dedupe(spark, sf_dir):
    """Each sequence number arrives twice here."""
    base = new_folder(spark, "stream_dedupe")
    events = _events_stream(spark, sf_dir)
    numbered = events.select(
        F.expr("event_id div 2").alias("seq"), F.col("ts").cast("timestamp").alias("received_at")
    )
    live.write_once(numbered, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").select("seq")
