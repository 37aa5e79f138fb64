"""Ordered computations without a single-task window.

A window over a whole table, or over one very large key, is a single Spark
task. The functions here cut the table into contiguous, evenly filled
*slices* of the order ``(by..., order...)`` first:

1. the slice bounds come from a small hash sample of the order columns, taken
   in a scalar subquery, so nothing runs until the caller's action;
2. the windows run inside ``(slice, by)``, in parallel;
3. each ``(slice, by)`` is reduced to one summary row, and a window over the
   summaries says what a slice needs from the slices before or after it. Only
   keys that cross a slice bound need that, at most two rows per slice, so the
   carried rows are broadcast whatever the size of the data.

The order must be total within ``by``: give a unique tie-breaker where the
first order column can repeat.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
MAX_SLICES = 1 << 16
SAMPLE_ROWS = 1 << 19
_HASH_SPACE = 1 << 40


def default_slices(df: DataFrame) -> int:
    """Two slices per shuffle task, so one heavy slice does not hold up a stage."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, min(MAX_SLICES, 2 * tasks))


def _ordering(order: Sequence[str]) -> Column:
    """One orderable column. A single one compares faster and keeps ``max_by`` in
    hash aggregation."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _end_value(col: str, order: Sequence[str], first: bool = False, known: bool = False) -> Column:
    """Aggregate: ``col`` on the last (first) row, or on the last (first) known one.

    A NULL order value sorts first, but ``max_by`` and ``min_by`` pass over it;
    as the order is total there is one such row at most, handled on its own.
    """
    at = _ordering(order)
    value = F.col(col)
    place = F.when(value.isNotNull(), at) if known else at
    found = F.min_by(value, place) if first else F.max_by(value, place)
    if len(order) > 1:
        return found
    unplaced = F.first(F.when(at.isNull(), value), ignorenulls=True)
    if first:
        return F.coalesce(unplaced, found)
    if known:
        return F.coalesce(found, unplaced)
    return F.when(F.max(at).isNotNull(), found).otherwise(unplaced)


def slice_bounds(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """One row with ``slices - 1`` ascending bounds on the order columns.

    Rows are picked by the hash of their order columns, so every evaluation of
    this frame gives the same bounds. 8 to 64 rows per slice are picked, about
    ``SAMPLE_ROWS`` at most whatever the table size; ``distinct`` keeps copies
    of one value from filling the sample.
    """
    per_slice = max(8, min(64, SAMPLE_ROWS // slices))
    wanted = float(slices * per_slice) * _HASH_SPACE
    rows = df.agg(F.count(F.lit(1))).scalar()
    keys = df.select(*order)
    picked = keys.filter(
        F.pmod(F.xxhash64(*order), F.lit(_HASH_SPACE)) < F.try_divide(F.lit(wanted), rows)
    ).distinct()
    ranked = picked.agg(F.array_sort(F.collect_list(_ordering(order))).alias("s"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.lit(slices - 1)),
        lambda i: F.get("s", F.floor(i.cast("bigint") * F.size("s") / F.lit(slices)).cast("int")),
    )
    return ranked.select(cuts.alias("bounds"))


def assign_slices(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add the slice number of each row: a binary search over the bounds.

    Each step is its own projection, which keeps the search inside generated
    code (a higher-order function would be about seven times slower).
    """
    count = slices or default_slices(df)
    out = df.withColumn("_bounds", slice_bounds(df, order, count).scalar()).withColumn(
        SLICE, F.lit(0)
    )
    key = _ordering(order)
    step = 1 << max(0, (count - 1).bit_length() - 1)
    while step:
        below = F.get(F.col("_bounds"), F.col(SLICE) + (step - 1)) <= key
        out = out.withColumn(SLICE, F.col(SLICE) + F.when(below, step).otherwise(0))
        step //= 2
    return out.drop("_bounds")


def _over_slices(by: Sequence[str], descending: bool = False):
    at = F.col(SLICE).desc() if descending else F.col(SLICE).asc()
    return Window.partitionBy(*by).orderBy(at)


def _before(by: Sequence[str], descending: bool = False):
    """All slices before this one in the given direction."""
    return _over_slices(by, descending).rowsBetween(Window.unboundedPreceding, -1)


def _within(by: Sequence[str], order: Sequence[str], descending: bool = False):
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return (
        Window.partitionBy(SLICE, *by)
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _attach(main: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join the carried rows. ``carry`` holds at most two rows per slice."""
    renamed = carry.withColumnsRenamed({c: f"_carry_{c}" for c in (SLICE, *by)})
    match = F.col(SLICE) == F.col(f"_carry_{SLICE}")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_carry_{c}"))
    joined = main.join(F.broadcast(renamed), match, "left")
    return joined.drop(*(f"_carry_{c}" for c in (SLICE, *by)))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "row_number",
    slices: int | None = None,
) -> DataFrame:
    """``row_number`` over the whole order (or per ``by``), from 1."""
    sliced = assign_slices(df, [*by, *order], slices)
    sizes = sliced.groupBy(SLICE, *by).agg(F.count(F.lit(1)).alias("_n"))
    carry = (
        sizes.withColumn("_offset", F.sum("_n").over(_before(by)))
        .filter(F.col("_offset").isNotNull())
        .drop("_n")
    )
    keys = [F.col(c) for c in order]
    local = F.row_number().over(Window.partitionBy(SLICE, *by).orderBy(*keys))
    main = _attach(sliced.withColumn("_local", local), carry, by)
    number = F.col("_local").cast("bigint") + F.coalesce("_offset", F.lit(0))
    return main.withColumn(name, number).drop(SLICE, "_local", "_offset")


def previous_values(
    df: DataFrame,
    order: Sequence[str],
    values: Mapping[str, str],
    by: Sequence[str] = (),
    slices: int | None = None,
    known: Sequence[str] = (),
) -> DataFrame:
    """``lag``: add, per ``{new name: column}``, the value on the row before.

    New names listed in ``known`` get the last known value on any row before.
    """
    sliced = assign_slices(df, [*by, *order], slices)
    ends = sliced.groupBy(SLICE, *by).agg(
        *(_end_value(col, order, known=new in known).alias(f"_end_{new}") for new, col in values.items())
    )
    over = _over_slices(by)

    def carried(new: str) -> Column:
        end = f"_end_{new}"
        return F.last(end, ignorenulls=True).over(_before(by)) if new in known else F.lag(end).over(over)

    carry = (
        ends.select(
            SLICE,
            *by,
            *(carried(new).alias(f"_in_{new}") for new in values),
            F.lag(SLICE).over(over).alias("_from"),
        )
        .filter(F.col("_from").isNotNull())
        .drop("_from")
    )
    local = Window.partitionBy(SLICE, *by).orderBy(*order)
    main = sliced.withColumn("_first", F.row_number().over(local) == 1).withColumns(
        {
            f"_lag_{new}": F.last(col, ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, -1))
            if new in known
            else F.lag(col).over(local)
            for new, col in values.items()
        }
    )
    main = _attach(main, carry, by)
    out = main.withColumns(
        {
            new: F.coalesce(f"_lag_{new}", f"_in_{new}")
            if new in known
            else F.when(F.col("_first"), F.col(f"_in_{new}")).otherwise(F.col(f"_lag_{new}"))
            for new in values
        }
    )
    helpers = [f"_{kind}_{new}" for kind in ("lag", "in") for new in values]
    return out.drop(SLICE, "_first", *helpers)


def _fill(df, order, values, by, slices, descending):
    sliced = assign_slices(df, [*by, *order], slices)
    ends = sliced.groupBy(SLICE, *by).agg(
        *(
            _end_value(col, order, first=descending, known=True).alias(f"_end_{col}")
            for col in values.values()
        )
    )
    before = _before(by, descending)
    carry = (
        ends.select(
            SLICE,
            *by,
            *(
                F.last(f"_end_{col}", ignorenulls=True).over(before).alias(f"_in_{col}")
                for col in values.values()
            ),
            F.lag(SLICE).over(_over_slices(by, descending)).alias("_from"),
        )
        .filter(F.col("_from").isNotNull())
        .drop("_from")
    )
    within = _within(by, order, descending)
    main = sliced.withColumns(
        {f"_near_{col}": F.last(col, ignorenulls=True).over(within) for col in values.values()}
    )
    main = _attach(main, carry, by)
    out = main.withColumns(
        {new: F.coalesce(f"_near_{col}", f"_in_{col}") for new, col in values.items()}
    )
    return out.drop(SLICE, *(f"_{kind}_{col}" for kind in ("near", "in") for col in values.values()))


def fill_forward(df, order, values: Mapping[str, str], by=(), slices=None) -> DataFrame:
    """Per ``{new name: column}``, the last known value up to this row."""
    return _fill(df, order, values, by, slices, descending=False)


def fill_backward(df, order, values: Mapping[str, str], by=(), slices=None) -> DataFrame:
    """Per ``{new name: column}``, the next known value from this row on.

    Runs over the descending order: a frame of *following* rows is evaluated
    anew for every row and takes quadratic time.
    """
    return _fill(df, order, values, by, slices, descending=True)


def fill_gaps(
    df: DataFrame,
    order: Sequence[str],
    values: Mapping[str, str],
    by: Sequence[str] = (),
    slices: int | None = None,
    keep_empty: bool = True,
) -> DataFrame:
    """Fill each run of missing values half from before, half from after.

    Of a run of ``L`` rows the first ``floor(L / 2)`` take the value before the
    run and the rest the value after it. A run at the start (end) of its key
    has no value before (after), so that half stays NULL.

    Per row this needs its distance to the known value on each side, or to the
    edge of the key. Inside a slice both are differences of row numbers; a
    slice bound inside a run adds the rows carried from the slices beyond it.

    ``keep_empty=False`` drops the keys none of whose columns has a value. A row
    that finds no value on either side belongs to such a key, so this needs no
    further look at the table.
    """
    columns = list(values.values())
    sliced = assign_slices(df, [*by, *order], slices)
    up = Window.partitionBy(SLICE, *by).orderBy(*(F.col(c).asc() for c in order))
    down = Window.partitionBy(SLICE, *by).orderBy(*(F.col(c).desc() for c in order))

    numbered = sliced.withColumn("_up", F.row_number().over(up).cast("bigint"))
    known = {c: F.when(F.col(c).isNotNull(), F.col("_up")) for c in columns}
    summary = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        summary += [
            F.max(known[c]).alias(f"_last_{c}"),
            F.max_by(c, known[c]).alias(f"_lastv_{c}"),
            F.min(known[c]).alias(f"_head_{c}"),
            F.min_by(c, known[c]).alias(f"_headv_{c}"),
        ]
    ends = numbered.groupBy(SLICE, *by).agg(*summary)

    past, ahead = _before(by), _before(by, descending=True)
    ends = ends.withColumns(
        {"_past": F.sum("_n").over(past), "_ahead": F.sum("_n").over(ahead)}
    ).filter(F.col("_past").isNotNull() | F.col("_ahead").isNotNull())
    ends = ends.withColumns(
        {"_past": F.coalesce("_past", F.lit(0)), "_ahead": F.coalesce("_ahead", F.lit(0))}
    )
    carried = {}
    for c in columns:
        last_at = F.col("_past") + F.col(f"_last_{c}")
        head_at = F.col("_ahead") + F.col("_n") - F.col(f"_head_{c}") + 1
        carried[f"_open_{c}"] = F.col("_past") - F.coalesce(
            F.max(last_at).over(past), F.lit(0)
        )
        carried[f"_close_{c}"] = F.col("_ahead") - F.coalesce(
            F.max(head_at).over(ahead), F.lit(0)
        )
        carried[f"_prev_{c}"] = F.last(f"_lastv_{c}", ignorenulls=True).over(past)
        carried[f"_next_{c}"] = F.last(f"_headv_{c}", ignorenulls=True).over(ahead)
    carry = ends.select(SLICE, *by, *(col.alias(name) for name, col in carried.items()))

    rising, falling = _within(by, order), _within(by, order, descending=True)
    main = numbered.withColumns(
        {f"_lu_{c}": F.last(known[c], ignorenulls=True).over(rising) for c in columns}
        | {f"_pv_{c}": F.last(c, ignorenulls=True).over(rising) for c in columns}
    )
    main = main.withColumn("_down", F.row_number().over(down).cast("bigint"))
    known_down = {c: F.when(F.col(c).isNotNull(), F.col("_down")) for c in columns}
    main = main.withColumns(
        {f"_ld_{c}": F.last(known_down[c], ignorenulls=True).over(falling) for c in columns}
        | {f"_nv_{c}": F.last(c, ignorenulls=True).over(falling) for c in columns}
    )
    main = _attach(main, carry, by)

    filled = {}
    for new, c in values.items():
        since = F.col("_up") - F.coalesce(f"_lu_{c}", -F.coalesce(f"_open_{c}", F.lit(0)))
        until = F.col("_down") - F.coalesce(f"_ld_{c}", -F.coalesce(f"_close_{c}", F.lit(0)))
        length = since + until - 1
        filled[new] = (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(since <= F.floor(length / 2), F.coalesce(f"_pv_{c}", f"_prev_{c}"))
            .otherwise(F.coalesce(f"_nv_{c}", f"_next_{c}"))
        )
    kinds = ("open", "close", "prev", "next", "lu", "pv", "ld", "nv")
    if not keep_empty:
        near = [f"_{kind}_{c}" for kind in ("pv", "prev", "nv", "next") for c in columns]
        main = main.filter(F.coalesce(*near).isNotNull())
    return main.withColumns(filled).drop(
        SLICE, "_up", "_down", *(f"_{kind}_{c}" for kind in kinds for c in columns)
    )
