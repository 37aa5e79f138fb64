"""Exact percentiles and timing summaries of groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import SLICE, _attach, _before, assign_slices

Extra = Callable[[Column, Column], Column]


def distribution(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    extra: Mapping[str, Extra] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Count and linearly interpolated quantiles of the non-null values, per ``by``.

    The built-in exact percentile keeps all distinct values of a group in one
    buffer. Here the values are counted first (copies collapse before the
    shuffle), the counts are accumulated slice by slice, and the rows that hold
    the wanted ranks are picked, so a group may be as large as the table.

    ``extra`` adds aggregates: each function gets the value column and the
    column that says how often the value occurs.
    """
    known = df.select(*by, F.col(value)).filter(F.col(value).isNotNull())
    sliced = assign_slices(known, [*by, value], slices)
    counts = sliced.groupBy(SLICE, *by, value).agg(F.count(F.lit(1)).alias("_n"))

    # From the counts, not from the input: both readers share one shuffle.
    sizes = counts.groupBy(SLICE, *by).agg(F.sum("_n").alias("_size"))
    carry = (
        sizes.withColumns(
            {
                "_offset": F.coalesce(F.sum("_size").over(_before(by)), F.lit(0)),
                "_all": F.sum("_size").over(Window.partitionBy(*by)),
            }
        )
        .filter(F.col("_all") > F.col("_size"))
        .drop("_size")
    )
    group = Window.partitionBy(SLICE, *by)
    running = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns(
        {"_end": F.sum("_n").over(running), "_total": F.sum("_n").over(group)}
    )
    ranked = _attach(ranked, carry, by).withColumns(
        {
            "_end": F.col("_end") + F.coalesce("_offset", F.lit(0)),
            "_total": F.coalesce("_all", "_total"),
        }
    )
    start = F.col("_end") - F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < F.col("_end")), F.col(value)))

    picks = []
    for name, q in quantiles.items():
        low = F.floor((F.col("_total") - 1) * F.lit(float(q)))
        high = F.least(low + 1, F.col("_total") - 1)
        picks += [at(low).alias(f"_low_{name}"), at(high).alias(f"_high_{name}")]
    more = [fn(F.col(value), F.col("_n")).alias(name) for name, fn in (extra or {}).items()]
    found = ranked.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), *more, *picks
    )

    def between(name: str, q: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(q))
        weight = position - F.floor(position)
        return F.col(f"_low_{name}") * (1 - weight) + F.col(f"_high_{name}") * weight

    return found.select(
        *by,
        "n",
        *(extra or {}),
        *(between(name, q).cast("double").alias(name) for name, q in quantiles.items()),
    )
