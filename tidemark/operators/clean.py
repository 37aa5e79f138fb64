"""Cleaning of measurement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..schemas import FILLED
from . import ordered


def without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: nan_to_null(F.col(c)) for c in columns})


def clamp_negative(df: DataFrame, columns: Sequence[str] = FILLED) -> DataFrame:
    """Negative values to 0; NULL stays NULL (``greatest`` would turn it into 0)."""
    return df.withColumns({c: F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)) for c in columns})


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def empty_entities(
    df: DataFrame, entity: str = "facility_code", columns: Sequence[str] = FILLED
) -> DataFrame:
    """Entities none of whose ``columns`` ever has a value."""
    seen = F.count_if(F.coalesce(*columns).isNotNull())
    return df.groupBy(entity).agg(seen.alias("_seen")).filter("_seen = 0").select(entity)


def drop_empty_entities(
    df: DataFrame, entity: str = "facility_code", columns: Sequence[str] = FILLED
) -> DataFrame:
    """Drop entities without any value, and rows without entity.

    Anti join against the empty entities: they are few as a rule, so the big
    side is not shuffled, and an entity of any size stays spread over tasks.
    """
    named = df.filter(F.col(entity).isNotNull())
    return named.join(empty_entities(named, entity, columns), entity, "left_anti")


def clean_measures(
    df: DataFrame,
    entity: str = "facility_code",
    order: Sequence[str] = ("ts",),
    columns: Sequence[str] = FILLED,
    slices: int | None = None,
) -> DataFrame:
    """Clamp, fill gaps, drop empty entities.

    The clamp comes first, as a clamped value is a known value for the fill. The
    fill itself sees which entities are empty.
    """
    named = clamp_negative(without_nan(df, columns), columns).filter(F.col(entity).isNotNull())
    filled = ordered.fill_gaps(named, list(order), {c: c for c in columns}, [entity], slices, keep_empty=False)
    return drop_all_null(filled).select(*df.columns)


def quality_profile(
    df: DataFrame,
    entity: str,
    clamped: Sequence[str] = FILLED,
    measures: Sequence[str] = FILLED,
) -> DataFrame:
    """Negatives before and after clamping, missing values, entities, rows: one pass."""
    after = {c: F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)) for c in clamped}
    return df.agg(
        *(F.count_if(F.col(c) < 0).alias(f"{c}_negative_before") for c in clamped),
        *(F.count_if(after[c] < 0).alias(f"{c}_negative_after") for c in clamped),
        *(F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in measures),
        F.count_distinct(entity).alias("entities"),
        F.count(F.lit(1)).alias("rows"),
    )


def written_totals(clamped: Sequence[str] = FILLED, measures: Sequence[str] = FILLED, ts: str = "ts") -> dict[str, Column]:
    """Aggregates for a sink's ``totals``: rows, time range, negatives and missing values."""
    return {
        "rows": F.count(F.lit(1)),
        "first_ts": F.min(ts),
        "last_ts": F.max(ts),
        **{f"{c}_negative": F.count_if(F.col(c) < 0) for c in clamped},
        **{f"{c}_missing": F.count_if(F.col(c).isNull()) for c in measures},
    }


def in_range(df: DataFrame, start, end, ts: str = "ts", date: str = "event_date") -> DataFrame:
    """Rows with ``start <= ts <= end``; reaches the scan as a pushed filter.

    A table partitioned by the day of ``ts`` (UTC for instants) in a column
    ``date`` is read only for the days of the range.
    """
    rows = df.filter(F.col(ts).between(start, end))
    if date not in df.columns:
        return rows
    low, high = (F.to_date(F.lit(t) if not isinstance(t, Column) else t) for t in (start, end))
    return rows.filter(F.col(date).between(low, high))
