"""Table and message sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.ordered import default_slices


def _write(df: DataFrame, path: str, partition_by: str | None, mode: str, totals: Mapping[str, Column] | None) -> dict:
    """Write, and return what was counted on the way.

    The totals stand directly below the write, where a task counts once, however
    often it or a stage before it runs.
    """
    if not totals:
        seen, rows = None, df
    elif mode == "ignore":
        raise ValueError("totals need a write that takes place")
    else:
        seen = Observation()
        rows = df.observe(seen, *(total.alias(name) for name, total in totals.items()))
    writer = rows.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return dict(seen.get) if seen else {}


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    mode: str = "overwrite",
    totals: Mapping[str, Column] | None = None,
) -> dict:
    """Parquet table, partitioned by day on request.

    The rebalance hint gathers each partition value into few files and lets the
    adaptive planner split a value that is too large for one task.

    ``totals`` are aggregates over the written rows by name. They come with the write
    itself, without a second scan, and are returned. Exact distinct counts are not
    possible there.
    """
    rows = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    return _write(rows, path, partition_by, mode, totals)


def write_clustered(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    partition_by: str | None = None,
    mode: str = "overwrite",
    files: int | None = None,
    totals: Mapping[str, Column] | None = None,
) -> dict:
    """Parquet table in which each file holds one sorted range of ``order``.

    So the smallest and largest values that Parquet keeps for its row groups
    exclude all but the ranges a reader asks for, and ``partition_by``, which must
    rise with ``order`` as a day does with its times, excludes whole files. A day
    with many rows is cut into several ranges; rows of equal order values stay in
    one, so the order should end in a tie-breaker. ``files``: ranges, about.
    """
    keys = [*([partition_by] if partition_by else []), *order]
    ranged = df.repartitionByRange(files or default_slices(df), *keys).sortWithinPartitions(*keys)
    return _write(ranged, path, partition_by, mode, totals)


def write_once(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Build the table only if nothing is there yet."""
    write_table(df, path, partition_by, mode="ignore")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
