"""A training corpus from raw documents: filter, thin out, and mix.

``STAGES`` are applied in order. Each takes ``(spark, docs, sf_dir)`` and returns a
frame that is written as Parquet and read again as the next stage's documents. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from tidemark.llm.queries import SHARES
from tidemark.llm.text import table
from tidemark.session import settle

#: Documents that score below are dropped.
LEAST_QUALITY = 0.3
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose lines are good on the whole; the field is fitted on all labels."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.score(docs, model).filter(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that three documents or more repeat, but from the last of them."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that five-word shingles link at 0.8."""
    return ngram_join.drop_near_duplicates(docs, ngram_join.Rule(k=5, percent=80)).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a whole window of a benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return decontaminate.clean(docs, items, F.col("n_hit") > 0).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources; one row for each time a document is trained on, in training order."""
    return mixing.training_order(mixing.mix(docs, SHARES)).select(*COLUMNS, "size", "pass", "words", "position")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
]

#: The line-labelling field cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
