"""Small expressions and tables that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind a value inside one expression, so that it is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_words(text: Column) -> Column:
    """Number of runs of non-blank characters; NULL has none.

    Every word and the blanks behind it shrink to one character, so memory stays
    that of the text and no array of words is built.
    """
    bare = F.btrim(text, F.lit(BLANKS))
    return F.coalesce(
        F.length(F.regexp_replace(bare, rf"{WORD}[\x20\x09-\x0D]*", "x")), F.lit(0)
    ).cast("long")


def row_key(*columns: str) -> Column:
    """A hexadecimal order key that depends on the values only."""
    return F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))


def free_name(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that the frame does not use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name
