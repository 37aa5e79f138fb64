"""Mergeable summaries of gaps between deliveries, kept by day.

A summary counts values by bucket. A bucket holds the integers that agree in sign,
length and leading ``BITS`` binary digits, so it is at most ``2 ** (1 - BITS)`` of its
values wide, needs no knowledge of the data, and summaries of any parts of a table
add up to that of the whole. A quantile is the middle of the bucket that holds its
rank: at most ``2 ** -BITS`` of the value off.

The table of summaries has one folder a day, so a new day costs a scan of that day,
and writing a day again replaces it. Gaps across days follow from the first and last
delivery of each topic and day, which are kept beside it. Numbers below the table:
at most ``2 ** BITS`` buckets for each binary length, whatever the number of messages.

Defined results: deliveries are ordered by day and arrival number; a NULL topic is a
topic of its own; values that are NULL are not counted; no values, no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ordered import previous_values

BITS = 8
DAY = "event_date"


def bucket(value: Column) -> Column:
    """The smallest absolute value of the bucket, with the value's sign."""
    size = F.abs(value.cast("long"))
    drop = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)
    return F.when(value < 0, -low).otherwise(low)


def middle(low: Column) -> Column:
    """The value that stands for a bucket."""
    size = F.abs(low)
    drop = F.greatest(F.length(F.bin(size)) - BITS, F.lit(0))
    half = F.floor(F.call_function("shiftleft", F.lit(1).cast("long"), drop) / 2).cast("long")
    return F.when(low < 0, low - half).otherwise(low + half)


def summarize(values: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """(by..., bucket, n): how many non-null values fall in each bucket."""
    known = values.filter(F.col(value).isNotNull())
    return known.groupBy(*by, bucket(F.col(value)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quantiles(counts: DataFrame, wanted: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """Count and estimated quantiles per group; the window holds the buckets of a group only."""
    group = Window.partitionBy(*by)
    running = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merge(counts, by).withColumns({"end": F.sum("n").over(running), "total": F.sum("n").over(group)})
    picks = [
        F.min(F.when(F.col("end") > F.floor((F.col("total") - 1) * F.lit(float(q))), F.col("bucket"))).alias(name)
        for name, q in wanted.items()
    ]
    found = ranked.groupBy(*by).agg(F.sum("n").alias("n"), *picks)
    return found.withColumns({name: middle(F.col(name)) for name in wanted})


def write_days(captured: DataFrame, path: str, topic: str = "topic", time: str = "arrival_ns", order: str = "arrival_seq") -> None:
    """Summarize the days that ``captured`` holds whole, and replace them in the table."""
    rows = captured.select(DAY, F.col(topic).alias("topic"), F.col(time).alias("time"), F.col(order).alias("order"))
    before = previous_values(rows, ["order"], {"_before": "time"}, [DAY, "topic"])
    gaps = before.withColumn("gap", F.col("time") - F.col("_before"))
    counts = summarize(gaps, "gap", [DAY, "topic"])
    ends = rows.groupBy(DAY, "topic").agg(F.min_by("time", "order").alias("first"), F.max_by("time", "order").alias("last"))
    for part, name in ((counts, "counts"), (ends, "ends")):
        part = part.hint("rebalance", F.col(DAY))
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{path}/{name}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(topic, bucket, n) over all days, gaps from one day to a later one included."""
    ends = spark.read.parquet(f"{path}/ends")
    gap = F.col("first") - F.lag("last").over(Window.partitionBy("topic").orderBy(DAY))
    across = summarize(ends.select("topic", gap.alias("gap")), "gap", ["topic"])
    inside = spark.read.parquet(f"{path}/counts").select("topic", "bucket", "n")
    return merge(inside.unionByName(across), ["topic"])
