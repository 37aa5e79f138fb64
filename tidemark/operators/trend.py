"""Trend series of the newest messages. All frames here hold at most ``tail`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import to_wall
from ..schemas import METRICS

# Messages in the trend, labels on its value axis.
TAIL = 120
TICKS = 5


def trend_frame(messages: DataFrame, received: str = "received_at", arrival: str = "arrival_seq") -> DataFrame:
    """Time, facility, state and the four metrics; a metric the table lacks is 0."""
    have = messages.columns
    return messages.select(
        arrival,
        received,
        "facility_code",
        "state",
        *(F.col(m) if m in have else F.lit(0.0).alias(m) for m in METRICS),
    )


def trend_tail(frame: DataFrame, tail: int = TAIL, arrival: str = "arrival_seq") -> DataFrame:
    """The newest rows, with their 0-based place in time order."""
    newest = frame.orderBy(F.col(arrival).desc()).limit(tail)
    return newest.withColumn("place", F.row_number().over(Window.orderBy(arrival)) - 1)


def _bounds(tail: DataFrame, metrics: Sequence[str]) -> dict:
    everything = Window.partitionBy()
    low = F.least(*(F.min(m).over(everything) for m in metrics))
    high = F.greatest(*(F.max(m).over(everything) for m in metrics))
    return {
        "_low": low,
        "_high": F.when(high == low, low + 1.0).otherwise(high),
        "_rows": F.count(F.lit(1)).over(everything),
    }


def trend_scaled(
    frame: DataFrame, tail: int = TAIL, arrival: str = "arrival_seq", metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Long form: per metric and place, x and y scaled to 0..1 over one common range."""
    rows = trend_tail(frame, tail, arrival)
    rows = rows.withColumns(_bounds(rows, metrics))
    long = rows.unpivot(["place", "_low", "_high", "_rows"], list(metrics), "metric", "value")
    x = F.when(F.col("_rows") > 1, F.col("place") / (F.col("_rows") - 1)).otherwise(0.0)
    y = (F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    return long.filter(F.col("value").isNotNull()).select(
        "metric", "place", x.alias("x"), "value", y.alias("y")
    )


def _utc_wall(df: DataFrame, column: str) -> Column:
    instant = df.schema[column].dataType.typeName() == "timestamp"
    return to_wall(F.col(column), "UTC") if instant else F.col(column)


def trend_ticks(
    frame: DataFrame,
    tail: int = TAIL,
    received: str = "received_at",
    arrival: str = "arrival_seq",
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Axis labels: five even steps from the highest to the lowest value, and the
    UTC times of the first, middle and last row (once each, none for a single row)."""
    rows = trend_tail(frame, tail, arrival)
    rows = rows.withColumns(_bounds(rows, metrics))
    steps = rows.filter(F.col("place") == 0).select(
        "_low", "_high", F.explode(F.sequence(F.lit(0), F.lit(TICKS - 1))).alias("place")
    )
    level = F.col("_high") - (F.col("_high") - F.col("_low")) * F.col("place") / (TICKS - 1)
    y = steps.select(
        F.lit("y").alias("axis"),
        F.col("place").cast("int").alias("place"),
        level.alias("value"),
        F.format_string("%.0f", F.bround(level, 0)).alias("label"),
    )
    marks = F.col("place").isin(0) | (F.col("place") == F.floor(F.col("_rows") / 2)) | (
        F.col("place") == F.col("_rows") - 1
    )
    x = rows.filter((F.col("_rows") > 1) & marks).select(
        F.lit("x").alias("axis"),
        F.col("place").cast("int").alias("place"),
        F.lit(None).cast("double").alias("value"),
        F.substring(_utc_wall(rows, received).cast("string"), 12, 8).alias("label"),
    )
    return y.unionByName(x)
