"""Streams over files that land one by one, against the batch operators."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshot
from tidemark.plans.bindings import as_messages, as_raw, table
from tidemark.session import new_folder
from tidemark.sources import messages as intake
from tidemark.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark):
    """The events in four files, in arrival order, with rising file times."""
    folder = new_folder(spark, "landed")
    events = table(spark, SF, "events")
    for part in range(4):
        chunk = events.filter((F.col("event_id") >= part * 250) & (F.col("event_id") < (part + 1) * 250))
        chunk.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return folder


@pytest.fixture()
def stream(spark, landed):
    schema = table(spark, SF, "events").schema
    return intake.stream_files(spark, landed, schema, maxFilesPerTrigger="1")


def sorted_rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


COLUMNS = ["facility_code", "arrival_seq", "power_value"]


def test_snapshot_changes(spark, stream, landed):
    base = new_folder(spark, "s")
    live.write_changes(as_messages(stream), f"{base}/log", f"{base}/cp")
    want = sorted_rows(snapshot.latest_snapshot(as_messages(spark.read.parquet(landed))), COLUMNS)
    assert spark.read.parquet(f"{base}/log").select("batch_id").distinct().count() >= 4
    assert sorted_rows(live.read_changes(spark, f"{base}/log"), COLUMNS) == want
    live.compact_changes(spark, f"{base}/log", f"{base}/small")
    assert sorted_rows(live.read_changes(spark, f"{base}/small"), COLUMNS) == want


def test_kpis(spark, stream, landed):
    base = new_folder(spark, "k")
    live.write_kpis(as_messages(stream), f"{base}/out", f"{base}/cp")
    last = snapshot.latest_snapshot(as_messages(spark.read.parquet(landed)))
    assert live.read_newest(spark, f"{base}/out/kpis").first() == snapshot.store_kpis(last).first()


def test_last_n_and_restart(spark, stream, landed):
    base = new_folder(spark, "n")
    messages = as_messages(spark.read.parquet(landed))
    for _ in range(2):  # the second run finds nothing new
        live.write_last_n(as_messages(stream), f"{base}/store", f"{base}/cp", n=300)
    got = sorted_rows(live.read_newest(spark, f"{base}/store"), COLUMNS)
    assert got == sorted_rows(snapshot.last_messages(messages, 300), COLUMNS)


def test_repeated_batch_gives_the_same_store(spark, stream, landed):
    base = new_folder(spark, "r")
    live.write_last_n(as_messages(stream), f"{base}/store", f"{base}/cp", n=300)
    before = sorted_rows(live.read_newest(spark, f"{base}/store"), COLUMNS)
    newest = spark.read.parquet(f"{base}/store").agg(F.max("batch_id")).first()[0]
    held = spark.read.parquet(live._slot(f"{base}/store", newest - 1)).drop("batch_id")
    batch = as_messages(spark.read.parquet(landed)).filter("arrival_seq >= 750")
    live._write_slot(snapshot.last_messages(held.unionByName(batch), 300), f"{base}/store", newest)
    assert sorted_rows(live.read_newest(spark, f"{base}/store"), COLUMNS) == before


def test_normalize_and_dedupe(spark, stream, landed):
    base = new_folder(spark, "d")
    live.append_table(intake.normalize_messages(as_raw(stream)), f"{base}/t", f"{base}/cp")
    batch = intake.normalize_messages(as_raw(spark.read.parquet(landed)))
    assert sorted_rows(spark.read.parquet(f"{base}/t"), COLUMNS) == sorted_rows(batch, COLUMNS)

    numbered = stream.select((F.col("event_id") % 100).alias("seq"), F.col("ts").cast("timestamp").alias("received_at"))
    once = live.without_repeats(numbered, delay="40 days")
    live.append_table(once, f"{base}/u", f"{base}/ucp")
    assert sorted(r.seq for r in spark.read.parquet(f"{base}/u").collect()) == list(range(100))


def test_view(spark, stream, landed):
    """After every batch the view equals the batch operators over what has arrived."""
    base = new_folder(spark, "v")
    messages = as_messages(spark.read.parquet(landed))
    for _ in range(2):  # the second run finds nothing new
        live.write_view(as_messages(stream), f"{base}/view", f"{base}/cp", n=120, hours=24)
    store = snapshot.last_messages(snapshot.since_reset(messages, hours=24), 120)
    assert sorted_rows(live.read_view(spark, f"{base}/view", "store"), COLUMNS) == sorted_rows(store, COLUMNS)
    kpis = live.read_view(spark, f"{base}/view", "kpis").first()
    assert kpis == snapshot.store_kpis(snapshot.latest_snapshot(store)).first()
    want = snapshot.stream_status(messages, n=120, hours=24, fuel="Gas")
    got = live.view_status(spark, f"{base}/view", n=120, fuel="Gas")
    assert got.select(*want.columns).first() == want.first()
