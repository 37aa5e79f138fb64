"""Frame-level helpers that keep costly expressions from being repeated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_27_PLUS_1 = 134217729.0
EXACT_LIMIT = 4503599627370496.0


def compute_once(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str] | None = None) -> DataFrame:
    """Add columns whose expressions run once per row, whatever follows.

    A filter on an ordinary column moves below the projection that computes it
    and takes a copy of the expression along, so a parsed JSON body would be
    parsed again for every use in the filter. Filters do not cross a generator,
    so the values go through one that yields one row.
    """
    kept = df.columns if keep is None else list(keep)
    row = F.struct(*(col.alias(name) for name, col in columns.items()))
    return df.select(*kept, F.inline(F.array(row)))


def round_columns(df: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """``scalars.round_value`` on several columns, in steps of their own.

    One projection per step keeps the generated code small enough for the JIT
    compiler; as one expression per column it is four times slower.
    """
    scale = float(10**places)
    v = {c: F.col(c) for c in columns}
    product = {c: F.col(f"_product_{c}") for c in columns}
    high = {c: F.col(f"_high_{c}") for c in columns}
    whole = {c: F.col(f"_whole_{c}") for c in columns}
    error = {c: F.col(f"_error_{c}") for c in columns}
    rest = {c: F.col(f"_rest_{c}") for c in columns}

    out = df.withColumns(
        {f"_product_{c}": v[c] * scale for c in columns}
        | {f"_high_{c}": v[c] * TWO_27_PLUS_1 for c in columns}
    )
    out = out.withColumns(
        {f"_high_{c}": high[c] - (high[c] - v[c]) for c in columns}
        | {f"_whole_{c}": F.rint(product[c]) for c in columns}
    )
    out = out.withColumns(
        {f"_error_{c}": (high[c] * scale - product[c]) + (v[c] - high[c]) * scale for c in columns}
        | {f"_rest_{c}": product[c] - whole[c] for c in columns}
    )
    out = out.withColumns(
        {
            c: F.when(
                F.abs(product[c]) < EXACT_LIMIT,
                (
                    F.when((rest[c] == 0.5) & (error[c] > 0), whole[c] + 1)
                    .when((rest[c] == -0.5) & (error[c] < 0), whole[c] - 1)
                    .otherwise(whole[c])
                )
                / scale,
            ).otherwise(v[c])
            for c in columns
        }
    )
    kinds = ("product", "high", "whole", "error", "rest")
    return out.drop(*(f"_{kind}_{c}" for kind in kinds for c in columns))
