"""The batch job from landed responses to the publish set, table by table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.align import align_entities, enrich
from ..operators.clean import clean_measures, written_totals
from ..operators.publish import publish_messages, publish_sequence, replay_schedule, with_timestamp
from ..operators.rollup import metric_table, with_market
from ..schemas import METRIC_COLUMN
from ..sources.landed import facility_dimension, flatten_series, split_problems, unreadable_facilities
from ..sources.sinks import write_clustered, write_table


def bronze(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unit-level points of all responses, and the quarantined ones."""
    return split_problems(flatten_series(responses))


def silver(points: DataFrame) -> DataFrame:
    """One clean row per facility and time."""
    return clean_measures(metric_table(points))


def gold(clean: DataFrame, aligned: DataFrame, dedupe: bool = False) -> DataFrame:
    """The numbered publish set. A code listed in two states gives two rows per
    time, so the state belongs to the order."""
    return publish_sequence(
        enrich(clean, aligned, dedupe=dedupe), ["ts", "facility_code", "facility_name", "state", "lat", "lng"]
    )


def run(responses: DataFrame, aligned: DataFrame, target: str, market: DataFrame | None = None) -> dict:
    """Write quarantine, clean measures and publish set below ``target``; return the run's totals.

    ``market``: price and demand, one row per time, for all facilities.

    Each stage reads the table the stage before has written: that cuts the
    lineage, and the repeated passes of the ordered operators read columns of a
    table instead of parsing the responses again.
    """
    spark = responses.sparkSession
    day = F.to_date("ts")
    points, bad = bronze(responses)
    write_table(bad, f"{target}/quarantine")
    write_table(points.withColumn("event_date", day), f"{target}/points", "event_date")
    merged = metric_table(spark.read.parquet(f"{target}/points"), columns=METRIC_COLUMN)
    write_table(merged, f"{target}/measures")
    clean = clean_measures(spark.read.parquet(f"{target}/measures"))
    cleaned = write_table(clean.withColumn("event_date", day), f"{target}/clean", "event_date", totals=written_totals())
    rows = enrich(spark.read.parquet(f"{target}/clean"), aligned)
    if market is not None:
        rows = with_market(rows, market)
    write_table(rows, f"{target}/enriched")
    order = ["ts", "facility_code", "facility_name", "state", "lat", "lng"]
    numbered = publish_sequence(spark.read.parquet(f"{target}/enriched"), order)
    # By time and facility, so that a reader behind a cursor opens only what follows it.
    published = write_clustered(numbered, f"{target}/publish", ["ts", "facility_code", "seq"], "event_date", totals={"rows": F.count(F.lit(1))})
    return {"clean": cleaned, "publish": published}


def run_all(
    responses: DataFrame,
    facilities: DataFrame,
    register: DataFrame,
    planned: DataFrame,
    target: str,
    market: DataFrame | None = None,
    position: str = "position",
) -> dict:
    """The whole job: from landed responses and registers to the messages to send.

    Returns the totals of its tables.

    ``facilities``: facility responses (``body``) with their ``position``;
    ``register`` and ``planned`` as ``align_entities`` takes them.
    """
    spark = responses.sparkSession
    write_table(unreadable_facilities(facilities), f"{target}/facility_quarantine")
    dimension = facility_dimension(facilities).withColumn(position, F.lit(0))
    write_table(dimension, f"{target}/facilities")
    aligned = align_entities(spark.read.parquet(f"{target}/facilities"), register, planned, position)
    write_table(aligned, f"{target}/aligned")
    totals = run(responses, spark.read.parquet(f"{target}/aligned"), target, market)
    publish = with_timestamp(replay_schedule(spark.read.parquet(f"{target}/publish")))
    write_table(publish_messages(publish), f"{target}/messages")
    return totals
