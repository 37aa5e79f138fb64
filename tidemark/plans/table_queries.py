"""Queries over measurement tables: sources, cleaning, joins, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import request_key_parts
from ..functions.times import wall_micros
from ..operators import align, clean, ordered, publish, rollup, snapshot
from ..session import new_folder
from ..sources import landed, sinks
from .bindings import STATE, readings, readings_sql, table
from .registry import query

READINGS = f"with readings as ({readings_sql()}) "


# -- sources and sinks ---------------------------------------------------------


@query(
    "facility_dim_ingest",
    """select concat('S', s_suppkey) as facility_code, s_name as facility_name,
    case when s_nationkey % 5 <> 0 then s_acctbal / 100 end as lat,
    case when s_nationkey % 5 <> 0 then cast(s_nationkey * 1.5 as double) end as lng from supplier""",
)
def facility_dim_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.struct(
        (F.col("s_acctbal") / 100).alias("lat"), (F.col("s_nationkey") * F.lit(1.5)).alias("lng")
    )
    facility = F.struct(
        F.concat(F.lit("S"), "s_suppkey").alias("code"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 5 != 0, place).alias("location"),
    )
    bodies = table(spark, sf_dir, "supplier").select(
        F.to_json(F.struct(F.array(facility).alias("data"))).alias("body")
    )
    return landed.facility_dimension(bodies)


def series_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event: two power units (epoch and UTC text) and one emission
    unit (text on the Sydney clock, value sometimes missing)."""
    ts = F.col("ts")
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    body = F.format_string(
        '{"data":[{"results":[{"name":"u1","data":[[%d,%s]]},{"name":"u2","data":[["%sZ",%s],["bad",1]]}]},'
        '{"results":[{"name":"u1","data":[["%s",%s]]}]}]}',
        F.floor(wall_micros(ts) / 1000),
        F.col("value").cast("string"),
        text,
        (F.col("value") - 50).cast("string"),
        text,
        F.when(F.col("event_type") == "error", "null").otherwise(F.col("value").cast("string")),
    )
    url = F.concat(F.lit("https://host/data?facility_code=F"), "user_id", F.lit("&metrics=power&metrics=emissions"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("F"), "user_id").alias("facility_code"), "event_id", body.alias("body"), url.alias("url")
    )


@query(
    "series_flatten",
    """select event_id, concat('F', user_id) as facility_code, m.metric, m.unit_name,
      case m.unit_name || m.k when 'u1p' then epoch_us(ts) // 1000 * 1000 when 'u2p' then epoch_us(ts)
        when 'u1e' then epoch_us(ts - interval 11 hour) end as ts_us,
      case m.unit_name || m.k when 'u1p' then value when 'u2p' then value - 50 when 'u2b' then 1.0
        else case when event_type = 'error' then null else value end end as value,
      case when m.k = 'b' then 'unreadable' end as problem
    from events, (values ('power', 'u1', 'p'), ('power', 'u2', 'p'), ('power', 'u2', 'b'),
      ('emissions', 'u1', 'e')) m(metric, unit_name, k)""",
)
def series_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed.flatten_series(series_responses(spark, sf_dir))
    return rows.select(
        "event_id", "facility_code", "metric", "unit_name", F.unix_micros("ts").alias("ts_us"), "value", "problem"
    )


def defective_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event, most of them with a defect."""
    eid = F.col("event_id")
    point = (
        F.when(eid % 7 == 0, F.lit('["2025-10-05T02:30:00", 1]'))
        .when(eid % 7 == 1, F.lit('["2025-04-06T02:30:00", 1]'))
        .when(eid % 7 == 2, F.lit("[1.7613108e12, 1]"))
        .otherwise(F.lit("[1761310800000, 1]"))
    )
    part = F.concat(F.lit('{"results":[{"name":"u","data":['), point, F.lit("]}]}"))
    body = (
        F.when(eid % 5 == 0, F.lit("{bad"))
        .when(eid % 5 == 1, F.lit('{"data":[]}'))
        .otherwise(F.concat(F.lit('{"data":['), part, F.lit(","), part, F.lit("]}")))
    )
    metrics = (
        F.when(eid % 3 == 0, F.lit("&metrics=power&metrics=emissions&metrics=price"))
        .when(eid % 3 == 1, F.lit("&date_start=2025-10-24 00:00&metrics=p%6Fwer&metrics=foo"))
        .otherwise(F.when(eid % 2 == 0, F.lit("")).otherwise(F.lit("&metrics=power")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", body.alias("body"), F.concat(F.lit("https://host/data?a=b"), metrics).alias("url")
    )


@query(
    "series_quarantine",
    """with r as (select event_id, event_id % 5 as b, event_id % 7 as p,
      unnest(case event_id % 3 when 0 then ['power', 'emissions', 'price'] when 1 then ['power', 'foo']
        else case when event_id % 2 = 0 then [null] else ['power'] end end) as metric from events),
    w as (select event_id, metric, case when b = 0 then 'unreadable_body' when metric is null then 'no_metrics'
      when metric = 'foo' then 'unknown_metric' when b = 1 then 'no_data'
      when p = 0 then 'gap' when p = 1 then 'overlap' end as problem from r)
    select event_id, metric, problem, count(*) as rows from w group by all""",
)
def series_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, good (no problem) and quarantined ones."""
    rows = landed.flatten_series(defective_responses(spark, sf_dir))
    return rows.groupBy("event_id", "metric", "problem").agg(F.count(F.lit(1)).alias("rows"))


@query("csv_scan", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv_scan")
    sinks.write_csv(table(spark, sf_dir, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return landed.read_csv(spark, path, schema)


@query(
    "table_sink",
    "select event_id, value, cast(cast(ts as date) as varchar) as event_date from events",
)
def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "table_sink")
    rows = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("event_date"))
    sinks.write_table(rows, path, "event_date")
    sinks.write_once(rows.limit(0), path, "event_date")
    return spark.read.parquet(path).select("event_id", "value", F.col("event_date").cast("string").alias("event_date"))


@query(
    "fetch_plan_anti",
    """select 'facility' as source, cast(c_custkey as varchar) as facility_code, '2025-10-24' as date_start,
    '2025-10-31' as date_end from customer
    where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')""",
)
def fetch_plan_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "customer").select(
        F.lit("facility").alias("source"),
        F.col("c_custkey").cast("string").alias("facility_code"),
        F.lit("2025-10-24").alias("date_start"),
        F.lit("2025-10-31").alias("date_end"),
    )
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    key = F.concat(F.lit("facility|"), F.col("o_custkey").cast("string"), F.lit("|2025-10-24|2025-10-31"))
    held = orders.select(request_key_parts(key).alias("k")).filter("k is not null").select("k.*")
    return landed.missing_requests(requested, held)


# -- cleaning ------------------------------------------------------------------


@query(
    "clamp_negative",
    READINGS
    + """select event_id, case when power_value < 0 then 0.0 else power_value end as power_value,
    case when emission_value < 0 then 0.0 else emission_value end as emission_value, price_per_mwh from readings""",
)
def clamp_negative(spark, sf_dir):
    out = clean.clamp_negative(readings(spark, sf_dir))
    return out.select("event_id", "power_value", "emission_value", "price_per_mwh")


@query(
    "drop_all_null",
    READINGS + "select power_value, emission_value from readings where power_value is not null or emission_value is not null",
)
def drop_all_null(spark, sf_dir):
    return clean.drop_all_null(readings(spark, sf_dir).select("power_value", "emission_value"))


ENTITY_SQL = """, e as (select *, concat(facility_code, '-', cast(ts as date)) as entity from readings) """


def _by_day(spark, sf_dir) -> DataFrame:
    day = F.to_date("ts").cast("string")
    return readings(spark, sf_dir).withColumn("entity", F.concat("facility_code", F.lit("-"), day))


@query(
    "drop_empty_entities",
    READINGS.rstrip()
    + ENTITY_SQL
    + """select event_id, entity, power_value from e where entity in (select entity from e group by entity
    having count(power_value) + count(emission_value) > 0)""",
)
def drop_empty_entities(spark, sf_dir):
    out = clean.drop_empty_entities(_by_day(spark, sf_dir), "entity")
    return out.select("event_id", "entity", "power_value")


def _fill_ctes(source: str) -> str:
    """CTEs p1, p2, e1, e2: per metric the run, place in run, length, and neighbours."""
    ctes = []
    for m, src in (("power_value", source), ("emission_value", "p2")):
        k = m[0]
        ctes.append(
            f"""{k}1 as (select *, count({m}) over (partition by facility_code order by ts rows unbounded preceding)
      as seg_{m} from {src}),
    {k}2 as (select *, sum(case when {m} is null then 1 else 0 end) over (partition by facility_code, seg_{m}
        order by ts rows unbounded preceding) as pos_{m},
      sum(case when {m} is null then 1 else 0 end) over (partition by facility_code, seg_{m}) as len_{m},
      last_value({m} ignore nulls) over (partition by facility_code order by ts rows unbounded preceding) as prev_{m},
      last_value({m} ignore nulls) over (partition by facility_code order by ts desc rows unbounded preceding) as next_{m}
      from {k}1)"""
        )
    return ", ".join(ctes)


def _fill_picks(rule: str) -> str:
    return ", ".join(rule.format(m=m) + f" as {m}" for m in ("power_value", "emission_value"))


def _fill_sql(rule: str) -> str:
    """``rule`` is the filled value of metric {m} over its neighbours."""
    return f"{READINGS.rstrip()}, {_fill_ctes('readings')} select event_id, facility_code, {_fill_picks(rule)} from e2"


HALF = """case when {m} is not null then {m} when pos_{m} <= len_{m} // 2 then prev_{m} else next_{m} end"""


@query("gap_fill", _fill_sql(HALF))
def gap_fill(spark, sf_dir):
    values = {m: m for m in ("power_value", "emission_value")}
    src = readings(spark, sf_dir).select("event_id", "facility_code", "ts", *values)
    return ordered.fill_gaps(src, ["ts"], values, ["facility_code"]).drop("ts")


@query("forward_fill", _fill_sql("prev_{m}"))
def forward_fill(spark, sf_dir):
    values = {m: m for m in ("power_value", "emission_value")}
    src = readings(spark, sf_dir).select("event_id", "facility_code", "ts", *values)
    return ordered.fill_forward(src, ["ts"], values, ["facility_code"]).drop("ts")


@query("backward_fill", _fill_sql("next_{m}"))
def backward_fill(spark, sf_dir):
    values = {m: m for m in ("power_value", "emission_value")}
    src = readings(spark, sf_dir).select("event_id", "facility_code", "ts", *values)
    return ordered.fill_backward(src, ["ts"], values, ["facility_code"]).drop("ts")


@query(
    "quality_profile",
    READINGS
    + """select count(*) filter (power_value < 0) as power_value_negative_before,
    count(*) filter (emission_value < 0) as emission_value_negative_before,
    count(*) filter (power_value < 0 and false) as power_value_negative_after,
    count(*) filter (emission_value < 0 and false) as emission_value_negative_after,
    count(*) filter (power_value is null) as power_value_missing, count(*) filter (emission_value is null) as emission_value_missing,
    count(*) filter (price_per_mwh is null) as price_per_mwh_missing, count(*) filter (demand_mw is null) as demand_mw_missing,
    count(distinct facility_code) as entities, count(*) as rows from readings""",
)
def quality_profile(spark, sf_dir):
    measures = ("power_value", "emission_value", "price_per_mwh", "demand_mw")
    return clean.quality_profile(readings(spark, sf_dir), "facility_code", measures=measures)


@query(
    "written_totals",
    READINGS
    + """select count(*) as rows, epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us,
    count(*) filter (power_value < 0) as power_value_negative, count(*) filter (emission_value < 0) as emission_value_negative,
    count(*) filter (power_value is null) as power_value_missing, count(*) filter (emission_value is null) as emission_value_missing
    from readings""",
)
def written_totals(spark, sf_dir):
    """Totals that come with the write of a table by day."""
    rows = readings(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    both = ("power_value", "emission_value")
    totals = clean.written_totals(both, both, "_us")
    seen = sinks.write_table(
        rows.withColumn("_us", wall_micros(F.col("ts"))), new_folder(spark, "totals"), "event_date", totals=totals
    )
    names = {"first_ts": "first_us", "last_ts": "last_us"}
    return spark.range(1).select(*(F.lit(v).cast("bigint").alias(names.get(c, c)) for c, v in seen.items()))


RANGE = ("2024-01-08 00:00:00", "2024-01-15 12:00:00")


@query(
    "range_scan_by_day",
    READINGS
    + f"select event_id, power_value from readings where ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'",
)
def range_scan_by_day(spark, sf_dir):
    """The same over a table partitioned by day, of which only the days of the range are read."""
    path = new_folder(spark, "by_day")
    sinks.write_table(readings(spark, sf_dir).withColumn("event_date", F.to_date("ts")), path, "event_date")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in RANGE)
    return clean.in_range(spark.read.parquet(path), start, end).select("event_id", "power_value")


@query(
    "range_scan",
    READINGS
    + f"select event_id, power_value from readings where ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'",
)
def range_scan(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in RANGE)
    return clean.in_range(readings(spark, sf_dir), start, end).select("event_id", "power_value")


# -- roll-up and merges ---------------------------------------------------------


@query(
    "unit_rollup",
    """select l_suppkey, epoch_us(l_shipdate) as ship_us,
    coalesce(sum(case when l_returnflag = 'N' then null else l_quantity end), 0.0) as value
    from lineitem group by all""",
)
def unit_rollup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", F.expr("case when l_returnflag = 'N' then null else l_quantity end").alias("value")
    )
    out = rollup.unit_rollup(lines, ["l_suppkey", "l_shipdate"])
    return out.select("l_suppkey", wall_micros(F.col("l_shipdate")).alias("ship_us"), "value")


MERGE_SQL = """with one as (select concat('F', user_id) as facility_code, cast(cast(ts as date) as varchar) as day,
  round_even(coalesce(sum(value), 0.0), 2) as {a} from events where event_type = 'view' group by all),
two as (select concat('F', user_id) as facility_code, cast(cast(ts as date) as varchar) as day,
  round_even(coalesce(sum(value), 0.0), 2) as {b} from events where event_type = 'click' group by all)
select facility_code, day, {a}, {b} from one full join two using (facility_code, day)"""


def _daily(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("F"), "user_id").alias("facility_code"),
        F.to_date("ts").cast("string").alias("day"),
        F.col("event_type").alias("metric"),
        "value",
    )


@query("metric_outer_join", MERGE_SQL.format(a="power_value", b="price_per_mwh"))
def metric_outer_join(spark, sf_dir):
    keys = ["facility_code", "day"]
    daily = _daily(spark, sf_dir)
    sides = [
        rollup.unit_rollup(daily.filter(F.col("metric") == m), keys, name=name).withColumn(name, F.bround(name, 2))
        for m, name in (("view", "power_value"), ("click", "price_per_mwh"))
    ]
    return rollup.outer_merge(*sides, keys)


@query("metric_table", MERGE_SQL.format(a="power_value", b="emission_value"))
def metric_table(spark, sf_dir):
    names = {"view": "power_value", "click": "emission_value"}
    out = rollup.metric_table(_daily(spark, sf_dir), ("facility_code", "day"), columns=names)
    return out.withColumns({c: F.bround(c, 2) for c in names.values()})


@query(
    "union_by_name",
    """select o_orderkey, o_custkey as custkey, null::double as c_acctbal from orders
    union all by name select c_custkey as custkey, c_acctbal, null::bigint as o_orderkey from customer""",
)
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_acctbal")
    return rollup.union_frames(orders, customers)


# -- joins ----------------------------------------------------------------------


@query(
    "contains_join",
    """select item_id, doc_id from (select item_id, text as t from benchmark) b
    join documents d on contains(d.text, b.t)""",
)
def contains_join(spark, sf_dir):
    return _passages(spark, sf_dir, "inner")


@query(
    "contains_join_left",
    """select item_id, doc_id from (select item_id, text as t from benchmark) b
    left join documents d on contains(d.text, b.t)""",
)
def contains_join_left(spark, sf_dir):
    return _passages(spark, sf_dir, "left")


@query(
    "contains_join_regex",
    """select region, o_orderkey from (select n_regionkey as region, concat('^', n_nationkey, '[0-9]*$') as pattern from nation
      union all select r_regionkey + 100, concat('9', r_regionkey) from region) p
    join (select o_orderkey, cast(o_custkey as varchar) as t from orders) o on regexp_matches(t, pattern)""",
)
def contains_join_regex(spark, sf_dir):
    """Some names are regular expressions, some are plain."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("region"), F.concat(F.lit("^"), "n_nationkey", F.lit("[0-9]*$")).alias("pattern")
    )
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 100).alias("region"), F.concat(F.lit("9"), "r_regionkey").alias("pattern")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    joined = align.contains_join(nations.unionByName(regions), orders, "pattern", "customer", regex=True)
    return joined.select("region", "o_orderkey")


def _passages(spark, sf_dir, how) -> DataFrame:
    passages = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "passage")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.contains_join(passages, docs, "passage", "text", how).select("item_id", "doc_id")


@query(
    "align_entities",
    f"""with f as (select n_name as facility_name, concat('N', n_nationkey) as facility_code,
      cast(n_nationkey * 0.5 as double) as lat,
      case when n_nationkey <> 7 then cast(n_regionkey * 1.5 as double) end as lng from nation),
    r as (select concat('NATION_', c_nationkey, ' ', c_mktsegment) as register_name, c_custkey as position,
      case when c_custkey % 50 <> 0 then {STATE} end as state,
      c_mktsegment as primary_fuel from (select *, c_custkey // 3 as user_id from customer)),
    p as (select concat('Plant NATION_', s_nationkey) as planned_name, s_suppkey as position,
      case s_suppkey % 4 when 0 then 'Solar' when 1 then 'Wind' when 2 then 'Hydro' end as future_fuel from supplier),
    a as (select f.*, r.primary_fuel, r.state, r.position as rp from f join r on contains(r.register_name, f.facility_name)),
    b as (select a.*, p.future_fuel, p.position as pp from a left join p on contains(p.planned_name, a.facility_name)),
    d as (select facility_name, facility_code, lat, lng, state, primary_fuel, future_fuel,
      row_number() over (partition by facility_name, facility_code, lat, lng, state, primary_fuel, future_fuel
        order by rp, pp) as k, rp, pp from b)
    select facility_name, facility_code, lat, lng, state,
      array_to_string(list_concat(list(coalesce(primary_fuel, '?') order by rp, pp),
        coalesce(list(future_fuel order by rp, pp) filter (future_fuel is not null), [])), ',') as fuels
    from d where k = 1 and lat is not null and lng is not null and state is not null group by all""",
)
def align_entities(spark, sf_dir):
    facilities = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("facility_name"),
        F.concat(F.lit("N"), "n_nationkey").alias("facility_code"),
        (F.col("n_nationkey") * 0.5).alias("lat"),
        F.when(F.col("n_nationkey") != 7, F.col("n_regionkey") * 1.5).alias("lng"),
        F.col("n_nationkey").alias("position"),
    )
    register = table(spark, sf_dir, "customer").withColumn("user_id", F.expr("c_custkey div 3")).select(
        F.concat(F.lit("NATION_"), "c_nationkey", F.lit(" "), "c_mktsegment").alias("register_name"),
        F.expr(f"case when c_custkey % 50 <> 0 then {STATE} end").alias("state"),
        F.col("c_mktsegment").alias("primary_fuel"),
        F.col("c_custkey").alias("position"),
    )
    planned = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Plant NATION_"), "s_nationkey").alias("planned_name"),
        F.expr("case s_suppkey % 4 when 0 then 'Solar' when 1 then 'Wind' when 2 then 'Hydro' end").alias("future_fuel"),
        F.col("s_suppkey").alias("position"),
    )
    out = align.align_entities(facilities, register, planned)
    return out.withColumn("fuels", F.array_join("fuel_list", ",")).drop("fuel_list")


@query(
    "enrich_join",
    """select o_orderkey, c_name, c_mktsegment, n_name from orders
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
)
def enrich_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    dim = align.enrich(customers, nations, on="c_nationkey")
    out = align.enrich(orders, dim, on="c_custkey")
    return out.select("o_orderkey", "c_name", "c_mktsegment", "n_name")


# -- publishing -----------------------------------------------------------------


def _for_publish(spark, sf_dir) -> DataFrame:
    """Hourly rows, so that many facilities share a time and the code decides."""
    rows = readings(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return rows.select("ts", "facility_code", "power_value", "emission_value", "event_id")


HOURLY = READINGS.rstrip() + ", h as (select * replace (date_trunc('hour', ts) as ts) from readings) "
NUMBERED = HOURLY.rstrip() + ", s as (select *, row_number() over (order by ts, facility_code, event_id) as seq from h) "
PUBLISH_ORDER = ["ts", "facility_code", "event_id"]


@query("publish_sequence", NUMBERED + "select event_id, facility_code, seq from s")
def publish_sequence(spark, sf_dir):
    out = publish.publish_sequence(_for_publish(spark, sf_dir), PUBLISH_ORDER)
    return out.select("event_id", "facility_code", "seq")


@query("replay_schedule", NUMBERED + "select event_id, seq, 5000000000 + seq * 100000000 as slot_mono_ns from s")
def replay_schedule(spark, sf_dir):
    numbered = publish.publish_sequence(_for_publish(spark, sf_dir), PUBLISH_ORDER)
    out = publish.replay_schedule(numbered, start_ns=5_000_000_000)
    return out.select("event_id", "seq", "slot_mono_ns")


CURSOR = ("2024-01-20 05:00:00", "F50")


@query(
    "cursor_increment",
    HOURLY
    + f"""select event_id, facility_code from h where ts > timestamp '{CURSOR[0]}'
    or (ts = timestamp '{CURSOR[0]}' and facility_code > '{CURSOR[1]}')""",
)
def cursor_increment(spark, sf_dir):
    at = F.lit(CURSOR[0]).cast("timestamp_ntz")
    return publish.after_cursor(_for_publish(spark, sf_dir), at, CURSOR[1]).select("event_id", "facility_code")


@query(
    "clustered_increment",
    HOURLY
    + f"""select event_id, facility_code from h where ts > timestamp '{CURSOR[0]}'
    or (ts = timestamp '{CURSOR[0]}' and facility_code > '{CURSOR[1]}')""",
)
def clustered_increment(spark, sf_dir):
    """The same from a publish table that is clustered by time and facility on write."""
    path = new_folder(spark, "clustered")
    rows = _for_publish(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    sinks.write_clustered(rows, path, PUBLISH_ORDER, "event_date")
    at = F.lit(CURSOR[0]).cast("timestamp_ntz")
    return publish.after_cursor(spark.read.parquet(path), at, CURSOR[1]).select("event_id", "facility_code")


@query(
    "publish_payload",
    NUMBERED
    + """select seq, concat('measurements/', facility_code) as topic, facility_code, power_value, emission_value,
    'MW' as power_unit, power_value is null as null_written from s""",
)
def publish_payload(spark, sf_dir):
    numbered = publish.publish_sequence(_for_publish(spark, sf_dir), PUBLISH_ORDER)
    sent = publish.publish_messages(numbered)
    fields = "seq bigint, facility_code string, power_value double, emission_value double, unit map<string,string>"
    back = sent.withColumn("p", F.from_json("body", fields))
    return back.select(
        "seq",
        "topic",
        "p.facility_code",
        "p.power_value",
        "p.emission_value",
        F.col("p.unit")["power_value"].alias("power_unit"),
        F.contains("body", F.lit('"power_value":null')).alias("null_written"),
    )


@query(
    "prepare_publish_set",
    READINGS.rstrip()
    + f""", z as (select * replace (case when power_value < 0 then 0.0 else power_value end as power_value,
      case when emission_value < 0 then 0.0 else emission_value end as emission_value) from readings),
    {_fill_ctes('z')}, x as (select event_id, facility_code, ts, {_fill_picks(HALF)} from e2"""
    + """), j as (select x.*, c_name as facility_name from x join customer on facility_code = concat('F', c_custkey))
    select event_id, facility_code, facility_name, power_value, emission_value,
      row_number() over (order by ts, facility_code, event_id) as seq from j""",
)
def prepare_publish_set(spark, sf_dir):
    """Clean, enrich and number the measurements, end to end."""
    measures = readings(spark, sf_dir).select("event_id", "facility_code", "ts", "power_value", "emission_value")
    dim = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("F"), "c_custkey").alias("facility_code"), F.col("c_name").alias("facility_name")
    )
    path = new_folder(spark, "prepare")
    sinks.write_table(align.enrich(clean.clean_measures(measures), dim), path)
    out = publish.publish_sequence(spark.read.parquet(path), PUBLISH_ORDER)
    return out.select("event_id", "facility_code", "facility_name", "power_value", "emission_value", "seq")


@query(
    "clean_latest_kpis",
    READINGS.rstrip()
    + f""", z as (select * replace (case when power_value < 0 then 0.0 else power_value end as power_value,
      case when emission_value < 0 then 0.0 else emission_value end as emission_value) from readings),
    {_fill_ctes('z')}, x as (select event_id, facility_code, price_per_mwh, demand_mw, {_fill_picks(HALF)} from e2),
    s as (select * from x qualify row_number() over (partition by facility_code order by event_id desc) = 1)
    select count(*) as facility_count, round_even(coalesce(sum(power_value), 0), 2) as total_power,
      round_even(coalesce(sum(emission_value), 0), 2) as total_emission,
      round_even(coalesce(quantile_cont(price_per_mwh, 0.5) filter (price_per_mwh > 0), 0), 2) as median_price,
      round_even(coalesce(quantile_cont(demand_mw, 0.5) filter (demand_mw > 0), 0), 2) as median_demand from s""",
)
def clean_latest_kpis(spark, sf_dir):
    """Flagship: clean and gap-fill, then the latest row per facility and its KPIs."""
    latest = snapshot.latest_snapshot(clean.clean_measures(readings(spark, sf_dir)), arrival="event_id")
    return snapshot.snapshot_kpis(latest)
