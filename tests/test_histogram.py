"""Summaries by day against exact quantiles."""

import math
import random

from pyspark.sql import functions as F

from tidemark.operators import histogram
from tidemark.session import new_folder

WANTED = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def test_buckets(spark):
    edge = [0, 1, -1, 255, 256, 257, -256, 511, 512, 2**40 + 12345, -(2**62), 2**63 - 1]
    rows = spark.createDataFrame([(v,) for v in edge], "v long")
    for r in rows.select("v", histogram.bucket(F.col("v")).alias("b"), histogram.middle(histogram.bucket(F.col("v"))).alias("m")).collect():
        assert abs(r.b) <= abs(r.v) and abs(r.m - r.v) <= abs(r.v) / 2**histogram.BITS
        assert abs(r.v) >= 256 or r.m == r.b == r.v


def test_days_add_up_and_are_replaced(spark):
    rng = random.Random(3)
    rows, clock = [], {}
    for i in range(6000):
        topic = rng.choice(["a", "a", "a", "b", None])
        clock[topic] = clock.get(topic, 0) + int(rng.lognormvariate(15, 3))
        rows.append((f"2024-01-0{1 + i // 1500}", topic, i, clock[topic]))
    df = spark.createDataFrame(rows, "event_date string, topic string, arrival_seq long, arrival_ns long")
    df = df.withColumn("event_date", F.to_date("event_date"))
    path = new_folder(spark, "days")
    histogram.write_days(df.filter("event_date <= date'2024-01-03'"), path)
    before = {r.f: r.n for r in spark.read.parquet(f"{path}/counts").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    for _ in range(2):  # a day that comes twice counts once, and touches no other day
        histogram.write_days(df.filter("event_date = date'2024-01-04'"), path)
    after = {r.f for r in spark.read.parquet(f"{path}/counts").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert set(before) < after
    got = {r.topic: r for r in histogram.quantiles(histogram.read_counts(spark, path), WANTED, ["topic"]).collect()}
    assert set(got) == {"a", "b", None}
    for topic, r in got.items():
        times = [t for _, name, _, t in rows if name == topic]
        gaps = sorted(b - a for a, b in zip(times, times[1:]))
        assert r.n == len(gaps)
        for name, q in WANTED.items():
            exact = gaps[math.floor((len(gaps) - 1) * q)]
            assert abs(r[name] - exact) <= exact / 2**histogram.BITS
    none = histogram.quantiles(histogram.summarize(df.limit(0), "arrival_ns", ["topic"]), WANTED, ["topic"])
    assert none.count() == 0
