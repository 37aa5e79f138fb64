"""From unit readings to one row per facility and time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import METRIC_COLUMN

MARKET = ("price_per_mwh", "demand_mw")


def unit_rollup(df: DataFrame, keys: Sequence[str], value: str = "value", name: str = "value") -> DataFrame:
    """Sum over units. A group of only missing values sums to 0, not NULL."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))


def metric_table(
    series: DataFrame,
    keys: Sequence[str] = ("facility_code", "ts"),
    metric: str = "metric",
    value: str = "value",
    columns: Mapping[str, str] = METRIC_COLUMN,
) -> DataFrame:
    """Roll up and merge all metrics in one aggregation, with one shuffle.

    Equals a roll-up per metric followed by full outer joins on the keys: a
    metric absent at a key is NULL, a present one with no value is 0.
    """

    def merged(m: str):
        mine = F.col(metric) == m
        total = F.coalesce(F.sum(F.when(mine, F.col(value))), F.lit(0.0))
        return F.when(F.count_if(mine) > 0, total)

    return series.filter(F.col(metric).isin(*columns)).groupBy(*keys).agg(
        *(merged(m).alias(name) for m, name in columns.items())
    )


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join; with an empty side the other side is kept, with NULL columns."""
    return left.join(right, list(keys), "full")


def with_market(rows: DataFrame, market: DataFrame, ts: str = "ts", columns: Sequence[str] = MARKET) -> DataFrame:
    """Add market values, which are stored once per time, to all facilities' rows.

    A row's own value is kept. Several market rows of one time are reduced to the
    largest value of each column first, so no row is doubled.
    """
    once = market.groupBy(F.col(ts).alias("_ts")).agg(*(F.max(c).alias(f"_{c}") for c in columns))
    joined = rows.join(once, F.col(ts) == F.col("_ts"), "left")
    own = {c: F.coalesce(c, f"_{c}") if c in rows.columns else F.col(f"_{c}") for c in columns}
    return joined.withColumns(own).drop("_ts", *(f"_{c}" for c in columns))


def union_frames(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing in one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
