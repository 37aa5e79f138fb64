"""The live view of messages: last N, latest per facility, KPIs, map data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import any_contains, round_value, short_number
from ..session import settle
from .distribution import distribution

# Messages in the live store, hours between soft resets.
STORE_SIZE = 1000
RESET_HOURS = 6.0
ALL = "All"
# The choices of the two filters, the columns of the preview, the
# fields of the latest message, the lines of a map popup (label, column, unit),
# and the fuels behind the colours of the map.
FUELS = (ALL, "Solar", "Wind", "Hydro", "Gas", "Coal", "Battery", "Biomass")
REGIONS = (ALL, "ACT", "NSW", "NT", "QLD", "SA", "TAS", "VIC", "WA")
PREVIEW = (
    "facility_code",
    "facility_name",
    "state",
    "fuel_list",
    "power_value",
    "emission_value",
    "price_per_mwh",
    "demand_mw",
    "timestamp",
)
DETAIL_LINES = (
    ("Facility Code", "facility_code", ""),
    ("Region", "state", ""),
    ("Fuel Type", "fuel_list", ""),
    ("Last Payload Time", "timestamp", ""),
    ("Power Output", "power_value", "MW"),
    ("CO2 Emissions", "emission_value", "tCO2e"),
    ("Current Price", "price_per_mwh", "$/MWh"),
    ("Grid Demand", "demand_mw", "MW"),
)
RENEWABLE = ("Solar", "Wind", "Hydro")
LATEST_FIELDS = ("facility_code", "facility_name", "state", "fuel_list", "timestamp", "received_at")


def last_messages(messages: DataFrame, n: int = STORE_SIZE, arrival: str = "arrival_seq") -> DataFrame:
    """The newest ``n`` messages by arrival: a per-task top-n, then one small merge."""
    return messages.orderBy(F.col(arrival).desc()).limit(max(0, n))


def latest_message(messages: DataFrame, arrival: str = "arrival_seq") -> DataFrame:
    return last_messages(messages, 1, arrival)


def latest_snapshot(
    messages: DataFrame, entity: str = "facility_code", arrival: str | Sequence[str] = "arrival_seq"
) -> DataFrame:
    """Last message per facility, by arrival (one column, or several in order). The rank
    limit is applied before the shuffle, so a facility of any size sends one row per task."""
    order = [arrival] if isinstance(arrival, str) else arrival
    last = Window.partitionBy(entity).orderBy(*(F.col(c).desc() for c in order))
    named = messages.filter(F.coalesce(F.col(entity), F.lit("")) != "")
    return named.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")


def _has_fuel(df: DataFrame, column: str, *tokens: str) -> Column:
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return any_contains(F.col(column), *tokens)
    return any_contains(F.array(column), *tokens)


def filter_snapshot(snapshot: DataFrame, fuel: str = ALL, region: str = ALL) -> DataFrame:
    """Fuel is a substring of the fuel list, region an exact state; "All" is no filter."""
    out = snapshot
    if fuel != ALL:
        out = out.filter(_has_fuel(out, "fuel_list", fuel))
    if region != ALL:
        out = out.filter(F.col("state") == region)
    return out


def snapshot_kpis(snapshot: DataFrame, slices: int | None = None, settled: bool = False) -> DataFrame:
    """Facility count, total power and emission, medians of positive price and demand.

    The snapshot is read several times, so it is written to a table first, unless
    it is ``settled``: a plain read of one.
    """
    shown = snapshot.select("power_value", "emission_value", "price_per_mwh", "demand_mw")
    shown = shown if settled else settle(shown, "kpis")
    totals = shown.agg(
        F.count(F.lit(1)).alias("facility_count"),
        round_value(F.coalesce(F.sum("power_value"), F.lit(0.0))).alias("total_power"),
        round_value(F.coalesce(F.sum("emission_value"), F.lit(0.0))).alias("total_emission"),
    )
    positive = shown.unpivot([], ["price_per_mwh", "demand_mw"], "metric", "value").filter("value > 0")
    medians = distribution(positive, "value", {"median": 0.5}, ["metric"], slices=slices)

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("median")))

    pair = medians.agg(F.struct(of("price_per_mwh").alias("price"), of("demand_mw").alias("demand"))).scalar()
    return totals.withColumn("_m", pair).select(
        "*",
        round_value(F.coalesce("_m.price", F.lit(0.0))).alias("median_price"),
        round_value(F.coalesce("_m.demand", F.lit(0.0))).alias("median_demand"),
    ).drop("_m")


def store_kpis(snapshot: DataFrame) -> DataFrame:
    """The same KPIs with the built-in median, for a snapshot of a bounded store."""

    def median(name: str) -> Column:
        positive = F.when(F.col(name) > 0, F.col(name))
        return round_value(F.coalesce(F.median(positive), F.lit(0.0)))

    return snapshot.agg(
        F.count(F.lit(1)).alias("facility_count"),
        round_value(F.coalesce(F.sum("power_value"), F.lit(0.0))).alias("total_power"),
        round_value(F.coalesce(F.sum("emission_value"), F.lit(0.0))).alias("total_emission"),
        median("price_per_mwh").alias("median_price"),
        median("demand_mw").alias("median_demand"),
    )


def preview(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(*(c for c in PREVIEW if c in snapshot.columns)).orderBy("facility_code")


def map_points(snapshot: DataFrame, mode: str = "power_value") -> DataFrame:
    """Place, value, class colour and texts of each facility on the map."""
    is_power = mode == "power_value"
    unit, label = ("MW", "Power") if is_power else ("tCO2e", "Emissions")
    colour = (
        F.when(_has_fuel(snapshot, "fuel_list", *RENEWABLE), "green")
        .when(_has_fuel(snapshot, "fuel_list", "Gas"), "orange")
        .otherwise("red")
    )
    lines = [
        F.concat(F.lit(f"{name}: "), short_number(F.col(c)), F.lit(f" {u}"))
        if u
        else F.concat(F.lit(f"{name}: "), F.col(c).cast("string"))
        for name, c, u in DETAIL_LINES
    ]
    detail = F.concat_ws("\n", "facility_name", *lines)
    tooltip = F.format_string(
        "%s | %s: %s %s", "facility_name", F.lit(label), short_number(F.col(mode)), F.lit(unit)
    )
    return snapshot.select(
        "facility_code",
        "lat",
        "lng",
        F.col(mode).alias("value"),
        F.lit(unit).alias("unit"),
        F.lit(label).alias("label"),
        colour.alias("colour"),
        tooltip.alias("tooltip"),
        detail.alias("detail"),
    )


def fingerprint(
    snapshot: DataFrame, mode: str = "power_value", fuel: str = ALL, region: str = ALL
) -> DataFrame:
    """One row that changes when the drawn map would change.

    An order-free sum of row digests: rows are never gathered in one place. The
    sum of 60-bit digests is exact in a 38-digit decimal.
    """
    text = F.concat_ws(
        "|",
        F.col("facility_code"),
        F.format_string("%.5f", round_value(F.col("lat"), 5)),
        F.format_string("%.5f", round_value(F.col("lng"), 5)),
        F.coalesce("state", F.lit("")),
        F.coalesce(F.col("fuel_list").cast("string"), F.lit("")),
        F.coalesce("facility_name", "facility_code"),
    )
    digest = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return snapshot.agg(
        F.lit(mode).alias("mode"),
        F.lit(fuel).alias("fuel"),
        F.lit(region).alias("region"),
        F.count(F.lit(1)).alias("markers"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest"),
    )


def reset_epoch(received_micros: Column, start_micros: Column, hours: float = RESET_HOURS) -> Column:
    """Number of soft resets since the start: one every ``hours``, never if 0.

    Boundaries are fixed multiples of the interval; a live view would reset at
    its first refresh after each of them.
    """
    if hours <= 0:
        return F.lit(0).cast("bigint")
    return F.floor((received_micros - start_micros) / F.lit(int(hours * 3600 * 1000000)))


def since_reset(
    messages: DataFrame, received: str = "received_us", hours: float = RESET_HOURS, start: Column | None = None
) -> DataFrame:
    """Messages of the current epoch, with the ``epoch`` number. The first message
    marks the start unless one is given."""
    span = messages.agg(F.struct(F.min(received).alias("first"), F.max(received).alias("last"))).scalar()
    begin = span["first"] if start is None else start
    current = reset_epoch(span["last"], begin, hours)
    recent = messages
    if hours > 0:
        # The bounds of the epoch, on the column itself: a scan can skip what is older.
        size = F.lit(int(hours * 3600 * 1000000))
        recent = messages.filter((F.col(received) >= begin + current * size) & (F.col(received) < begin + (current + 1) * size))
    return recent.withColumn("epoch", reset_epoch(F.col(received), begin, hours))


def stream_status(
    messages: DataFrame,
    received: str = "received_us",
    arrival: str = "arrival_seq",
    n: int = STORE_SIZE,
    hours: float = RESET_HOURS,
    fuel: str = ALL,
    region: str = ALL,
) -> DataFrame:
    """One row: totals, time of last update and reset, and facilities in the store."""
    current = since_reset(messages, received, hours)
    store = last_messages(current, n, arrival)
    shown = latest_snapshot(store, arrival=arrival)
    totals = messages.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min(received).alias("first"))).scalar()
    total, begin = totals["n"], totals["first"]
    span = F.lit(int(hours * 3600 * 1000000))
    reset_at = begin + F.coalesce(F.max("epoch"), F.lit(0)) * span
    return current.agg(
        total.alias("total_messages"),
        F.count(F.lit(1)).alias("messages_since_reset"),
        F.least(F.count(F.lit(1)), F.lit(n)).alias("store_size"),
        F.max(received).alias("last_update_us"),
        reset_at.alias("last_reset_us"),
        ((F.max(received) - reset_at) / 1e6).alias("seconds_since_reset"),
        shown.agg(F.count(F.lit(1))).scalar().alias("facilities"),
        filter_snapshot(shown, fuel, region).agg(F.count(F.lit(1))).scalar().alias("facilities_shown"),
    )
