"""Every registered query against its SQL, and what its plan must not hold."""

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tidemark.operators.clean import clean_measures, in_range
from tidemark.operators.publish import after_cursor
from tidemark.plans.bindings import readings
from tidemark.plans.catalog import ORACLES, QUERIES
from tidemark.sources.sinks import write_table

from . import oracle

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert oracle.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def plan_of(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["gap_fill", "forward_fill", "backward_fill", "global_deltas", "topic_deltas", "sequence_gaps", "publish_sequence",
     "contains_join", "align_entities", "enrich_join", "metric_outer_join", "latest_snapshot", "drop_empty_entities"],
)
def test_no_pairwise_join(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_take_filters_and_columns(spark):
    plan = plan_of(spark, "range_scan")
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
    later = after_cursor(readings(spark, SF), F.lit("2024-01-20 05:00:00").cast("timestamp_ntz"), "F5")
    assert "GreaterThanOrEqual(ts" in later._jdf.queryExecution().executedPlan().toString()


def test_latest_limits_before_the_shuffle(spark):
    plan = plan_of(spark, "latest_snapshot")
    assert plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_of(spark, "last_n_messages")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_prune_partitions(spark, tmp_path):
    days = spark.range(40).select(
        F.timestamp_add("DAY", F.col("id"), F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")).alias("ts"),
        F.lit("F1").alias("facility_code"),
    )
    write_table(days.withColumn("event_date", F.to_date("ts")), f"{tmp_path}/t", "event_date")
    back = spark.read.parquet(f"{tmp_path}/t")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 00:00:00", "2024-01-12 06:00:00"))
    found = in_range(back, start, end)
    assert "PartitionFilters: [isnotnull(event_date" in plan_text(found) and found.count() == 3
    later = after_cursor(back, start, "F0")
    assert "PartitionFilters: [isnotnull(event_date" in plan_text(later) and later.count() == 31


def test_cleaning_has_no_anti_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(clean_measures(readings(spark, SF), order=["ts", "event_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" not in plan and "SortMergeJoin" not in plan
