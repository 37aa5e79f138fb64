"""Clustered tables, and totals that come with a write."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, publish
from tidemark.session import new_folder
from tidemark.sources import sinks


def readings(spark, n=40_000):
    """Five days, of which the third holds half of the rows; rows come in no order."""
    rows = spark.range(n).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
    second = F.when(F.col("h") < 500_000, 2 * 86_400 + F.col("h") % 86_400).otherwise(F.col("h") % (5 * 86_400))
    return rows.select(
        F.timestamp_seconds(1_700_006_400 + second).alias("ts"),
        F.concat(F.lit("F"), F.col("id") % 50).alias("facility_code"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 100 - 10.0).alias("power_value"),
        "id",
    ).withColumn("event_date", F.to_date("ts"))


def scanned(df):
    """(files, rows) that the scan of an unshuffled frame has read."""
    run = df._jdf.queryExecution()
    run.executedPlan().executeCollect()
    scan = run.executedPlan().collectLeaves().head()
    return tuple(scan.metrics().get(name).get().value() for name in ("numFiles", "numOutputRows"))


def test_cursor_reads_little_of_a_clustered_table(spark):
    rows = readings(spark)
    plain, clustered = new_folder(spark, "plain"), new_folder(spark, "clustered")
    rows.repartition(16).write.parquet(plain)
    sinks.write_clustered(rows, clustered, ["ts", "facility_code", "id"], "event_date", files=16)
    at = F.lit("2023-11-18 12:00:00").cast("timestamp")
    found = [publish.after_cursor(spark.read.parquet(p), at, "F7") for p in (plain, clustered)]
    assert sorted(r.id for r in found[0].collect()) == sorted(r.id for r in found[1].collect()) != []
    (files, read), (few_files, few_read) = (scanned(f) for f in found)
    assert few_files < files and few_read < read / 4
    # The day with half of the rows is cut, and files do not overlap.
    table = spark.read.parquet(clustered).withColumn("file", F.col("_metadata.file_path"))
    spans = table.groupBy("file").agg(F.min(F.struct("ts", "facility_code", "id")).alias("a"), F.max(F.struct("ts", "facility_code", "id")).alias("b"))
    spans = sorted((tuple(r.a), tuple(r.b)) for r in spans.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    per_day = {r.event_date: r.n for r in table.groupBy("event_date").agg(F.count_distinct("file").alias("n")).collect()}
    assert max(per_day.values()) >= 6


def test_totals_come_with_the_write(spark):
    rows = readings(spark)
    source = new_folder(spark, "source")
    rows.write.parquet(source)
    wanted = clean.quality_profile(rows, "facility_code", ["power_value"], ["power_value"]).first()
    data = spark.read.parquet(source)
    for write in (
        lambda to, t: sinks.write_table(data, to, "event_date", totals=t),
        lambda to, t: sinks.write_table(data, to, totals=t),
        lambda to, t: sinks.write_clustered(data, to, ["ts", "id"], "event_date", totals=t),
    ):
        seen = write(new_folder(spark, "written"), clean.written_totals(["power_value"], ["power_value"]))
        assert seen["rows"] == wanted.rows == 40_000
        assert seen["power_value_negative"] == wanted.power_value_negative_before
        assert seen["power_value_missing"] == wanted.power_value_missing
        assert seen["first_ts"] <= seen["last_ts"]
    # The plan that is written scans its source once and counts right below the write.
    seen = data.observe("totals", F.count(F.lit(1)).alias("rows"))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    empty = sinks.write_table(data.limit(0), new_folder(spark, "none"), totals=clean.written_totals(["power_value"], []))
    assert empty == {"rows": 0, "first_ts": None, "last_ts": None, "power_value_negative": 0}
    with pytest.raises(ValueError):
        sinks.write_table(data, source, mode="ignore", totals={"rows": F.count(F.lit(1))})
    assert sinks.write_table(data, new_folder(spark, "plain")) == {}
