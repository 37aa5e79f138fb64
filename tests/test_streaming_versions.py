"""Versioned stream tables: repeats, failures, merging, and what a batch reads."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import snapshot
from tidemark.plans.bindings import as_raw, table
from tidemark.session import new_folder
from tidemark.sources import messages as intake
from tidemark.streaming import committed, live, seen
from tidemark.streaming.versions import MERGE, RETAIN, Versions, read_table

SF = "/root/testdata/sf0.001"


def local(path):
    return path.removeprefix("file://")


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_readers_see_whole_versions(spark):
    """Folders of a failed batch are not seen, and go with a later commit."""
    path = new_folder(spark, "v")
    versions = Versions(spark, path)
    assert versions.newest() == {"folders": {}} and versions.numbers() == []
    lost = versions.write(spark.range(3), "t", 0)
    folders = []
    for i in range(RETAIN + 3):
        folders.append([versions.write(spark.range(i, i + 1), "t", i), 0])
        assert versions.newest()["folders"].get("t", []) == folders[:-1]
        versions.commit(i, {"folders": {"t": folders}, "schemas": {"t": spark.range(1).schema.jsonValue()}})
        assert rows_of(read_table(spark, path, "t"), "id") == [(j,) for j in range(i + 1)]
    assert versions.numbers() == list(range(3, RETAIN + 3))
    assert sorted(os.listdir(f"{local(path)}/t")) == sorted(f.split("/")[1] for f, _ in folders)
    assert lost.split("/")[1] not in os.listdir(f"{local(path)}/t")
    versions.commit(RETAIN + 2, {"folders": {}})  # a batch that is there stays as it is
    assert versions.newest()["folders"] == {"t": folders}
    assert versions.newest(before=5)["folders"]["t"] == folders[:5]


def test_snapshot_log_over_many_batches(spark, monkeypatch):
    """Many batches: few folders, and every version is the snapshot of what has come."""
    monkeypatch.setattr("tidemark.streaming.versions.MERGE", 3)
    path, rng = new_folder(spark, "log"), random.Random(1)
    want, most = {}, 0
    for i in range(60):
        rows = [(f"F{rng.randrange(12)}", 3 * i + j, float(i)) for j in range(2)]
        rows = list({r[0]: r for r in rows}.values())
        batch = spark.createDataFrame(rows, "facility_code string, arrival_seq long, power_value double").coalesce(1)
        held = read_table(spark, path, "changes") if i else None  # a reader that began before this batch
        before = dict(want)
        committed.add_changes(batch, i, path)
        if i % 20 == 7:
            committed.add_changes(batch, i, path)  # repeated
            assert {r.facility_code: r.arrival_seq for r in snapshot.latest_snapshot(held).collect()} == before
        want |= {r[0]: r[1] for r in rows}
        most = max(most, len(os.listdir(f"{local(path)}/changes")))
        if i % 20 == 19:
            got = committed.read_snapshot_log(spark, path).collect()
            assert {r.facility_code: r.arrival_seq for r in got} == want
    assert most < 24 and len(Versions(spark, path).numbers()) == RETAIN


MESSAGES = "partition int, offset long, received_at timestamp, body string"


def partitioned(spark, n=60):
    rng = random.Random(2)
    rows = [(p, o, None if rng.random() < 0.05 else f"2024-05-01 00:00:{rng.randrange(30):02}", f"b{p}-{o}") for p in range(3) for o in range(n)]
    df = spark.createDataFrame(rows, "partition int, offset long, at string, body string")
    return df.select("partition", "offset", F.col("at").cast("timestamp").alias("received_at"), "body")


def test_total_order_over_partitions(spark):
    df = partitioned(spark)
    got = intake.number_arrivals(df.repartition(5)).collect()
    want = sorted(df.collect(), key=lambda r: (r.received_at is not None, r.received_at or 0, r.partition, r.offset))
    assert [r.body for r in sorted(got, key=lambda r: r.arrival_seq)] == [r.body for r in want]
    assert sorted(r.arrival_seq for r in got) == list(range(180))
    assert intake.number_arrivals(df.limit(0)).collect() == []


def test_arrival_numbers_go_on_over_batches(spark):
    path, df = new_folder(spark, "a"), partitioned(spark, 40)
    batches = [df.filter(F.pmod("offset", F.lit(4)) == i) for i in range(4)]
    for i, batch in enumerate([batches[0], batches[1], df.limit(0), batches[2], batches[3]]):
        # An attempt that fails before its commit: the files are there, the version is not.
        versions = Versions(spark, path)
        versions.write(intake.number_arrivals(batch, first=versions.newest(i).get("next", 0)), "arrivals", i)
        for _ in range(2):
            committed.add_arrivals(batch, i, path)
        if i == 1:
            early = rows_of(read_table(spark, path, "arrivals"), "arrival_seq", "body")
    table = read_table(spark, path, "arrivals")
    assert sorted(r.arrival_seq for r in table.collect()) == list(range(120))
    assert set(early) <= set(rows_of(table, "arrival_seq", "body"))
    assert rows_of(table, "body") == rows_of(df, "body")


def test_quarantine_in_one_pass(spark):
    """Good and bad rows together are the input, after failures and repeats."""
    path = new_folder(spark, "q")
    raw = as_raw(table(spark, SF, "events"))
    parts = [raw.filter(F.pmod("arrival_seq", F.lit(12)) == i) for i in range(12)]
    parts[3] = parts[3].filter(F.col("body").startswith("{broken"))  # nothing good
    parts[4] = intake.normalize_messages(parts[4]).select("arrival_seq").join(parts[4], "arrival_seq").select(*raw.columns)  # nothing bad
    for i, part in enumerate(parts):
        versions = Versions(spark, path)
        versions.write(part.withColumn("kind", F.lit("messages")), "checked", i, "kind")  # a failed attempt
        for _ in range(2):
            committed.add_checked(part, i, path)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    good, bad = read_table(spark, path, "messages"), committed.read_quarantine(spark, path)
    assert good.columns == intake.normalize_messages(raw).columns
    assert rows_of(good, *good.columns) == rows_of(intake.normalize_messages(whole), *good.columns)
    assert rows_of(bad, "arrival_seq", "topic", "body", "reason") == rows_of(
        intake.quarantined_messages(whole), "arrival_seq", "topic", "body", "reason"
    )
    assert Versions(spark, path).newest()["rows"] == {"messages": good.count(), "quarantine": bad.count()}


def test_landed_parts_are_spread(spark):
    """A part is one batch, and no file of it holds most of its rows."""
    from tidemark.plans import message_queries

    base = new_folder(spark, "landed")
    spark = spark.newSession()
    # A table as small as this one would be put into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    sizes, seen = [], 0
    for stream in message_queries._landed(spark, SF, base, 2):
        sizes.append([])
        count = lambda df, _: sizes[-1].append(df.count())
        stream.writeStream.foreachBatch(count).option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
        files = spark.read.parquet(f"{base}/landed").groupBy(F.input_file_name()).count().collect()
        seen += sum(sizes[-1])
        assert sum(r["count"] for r in files) == seen
        assert max(r["count"] for r in files) <= 0.5 * sizes[-1][0]
    assert [len(s) for s in sizes] == [1, 1]
    assert seen == table(spark, SF, "events").count()


ROWS = "seq long, received_at timestamp"


def deliveries(spark, rows):
    df = spark.createDataFrame(rows, "seq long, at string")
    return df.select("seq", F.col("at").cast("timestamp").alias("received_at")).coalesce(1)


@pytest.fixture()
def sink(spark, monkeypatch):
    """The batch function of ``write_once``, called without a stream."""
    held = []
    monkeypatch.setattr(live, "_start", lambda writer, checkpoint, live: None)

    class Writer:
        def outputMode(self, mode):
            return self

        def foreachBatch(self, fn):
            held.append(fn)
            return self

    class Stream:
        writeStream = Writer()

    def make(path):
        live.write_once(Stream(), path, "unused")
        return held[-1]

    return make


def test_a_batch_reads_its_own_days_only(spark, sink, monkeypatch):
    """The bytes read do not become more with the batches; late first deliveries stay."""
    monkeypatch.setattr(seen, "FIRST_WORDS", 4)  # so that filters have to grow
    path, rng = new_folder(spark, "once"), random.Random(3)
    add, first, read = sink(path), {}, []
    whole = Versions.read

    def counting(self, folders, schema):
        read[-1] += sum(
            os.path.getsize(os.path.join(d, f)) for x in folders for d, _, fs in os.walk(f"{local(self.path)}/{x}") for f in fs
        )
        return whole(self, folders, schema)

    monkeypatch.setattr(Versions, "read", counting)
    for i in range(20):
        day = i // 2
        rows = [(1000 * i + j, f"2024-05-{day + 1:02} 10:00:00") for j in range(20)]
        rows += [(1000 * i + 500, "2024-04-01 00:00:00"), (None, f"2024-05-{day + 1:02} 11:00:00")]  # late, but new
        rows += [(1000 * (i - 1) + j, f"2024-05-{day + 1:02} 12:00:00") for j in range(5) if i]  # delivered again
        rng.shuffle(rows)
        read.append(0)
        batch = deliveries(spark, rows)
        add(batch, i)
        if i % 9 == 3:
            add(batch, i)
        for key, _ in rows:
            first.setdefault(key, i)
    table = spark.read.parquet(path)
    assert table.count() == len(first)
    assert {r.seq: r.batch_id for r in table.select("seq", "batch_id").collect()} == first
    # Filters of all days are read, a few KB each; the keys are those of a day or two.
    early, late = sum(read[5:10]) / 5, sum(read[15:20]) / 5
    assert late < 2.5 * early
    days = Versions(spark, f"{path}/_seen").newest()["days"]
    assert all(d["n"] <= d["words"] * seen.KEYS_PER_WORD and len(d["keys"]) <= MERGE for d in days.values())


def test_filters_hold_every_key(spark):
    keys = spark.range(5000).select(F.col("id").alias("key"), F.lit("d").alias("day"))
    bits = seen.bits_of(keys, 1024)
    other = spark.range(100_000, 120_000).select(F.col("id").alias("key"))
    assert seen.may_hold(keys.select("key"), bits, 1024).count() == 5000
    assert seen.may_hold(other, bits, 1024).count() < 0.02 * 20_000
