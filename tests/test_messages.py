"""Message intake, live view, trend and cadence."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cadence, snapshot, trend
from tidemark.sources import messages as intake

GOOD = {"facility_code": " A ", "lat": "-1.5", "lng": 2, "power_value": "2.675", "fuel_list": "['Gas']"}


def raw(spark, *bodies):
    rows = [(i, "site/x/1", b if isinstance(b, str) or b is None else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "arrival_seq long, topic string, body string")


def test_normalize(spark):
    full = GOOD | {
        "facility_name": "Zürich", "timestamp": "2025-10-25T00:00:00+11:00", "emission_value": "x", "price_per_mwh": -3.005,
        "demand_mw": 7, "state": "NSW", "unit": {"power_value": "MW"}, "seq": 4, "sent_mono_ns": 5,
    }
    out = intake.normalize_messages(raw(spark, GOOD, full)).orderBy("arrival_seq").collect()
    assert out[0].asDict() == {
        "arrival_seq": 0, "facility_code": "A", "facility_name": "A", "lat": -1.5, "lng": 2.0, "timestamp": "",
        "power_value": 2.67, "emission_value": 0.0, "price_per_mwh": 0.0, "demand_mw": 0.0,
        "state": "Unknown Region", "fuel_list": "['Gas']", "topic": "site/x/1",
    }
    assert (out[1].facility_name, out[1].emission_value, out[1].price_per_mwh, out[1].state) == ("Zürich", 0.0, round(-3.005, 2), "NSW")


def test_quarantine(spark):
    bodies = ["{bad", "[1]", "3", None, "", GOOD | {"facility_code": " "}, {k: v for k, v in GOOD.items() if k != "facility_code"},
              GOOD | {"lat": "abc"}, GOOD | {"lng": None}, GOOD | {"power_value": "NaN"}, GOOD | {"power_value": "1_000"}]
    df = raw(spark, *bodies)
    reasons = {r.arrival_seq: r.reason for r in intake.quarantined_messages(df).collect()}
    assert reasons == {
        0: "invalid_json", 1: "not_object", 2: "invalid_json", 3: "invalid_json", 4: "invalid_json", 5: "no_facility_code",
        6: "no_facility_code", 7: "bad_lat", 8: "bad_lng", 9: "bad_power_value",
    }
    assert [r.power_value for r in intake.normalize_messages(df).collect()] == [1000.0]


@pytest.mark.parametrize(
    "pattern,yes,no",
    [
        ("a/b/#", ["a/b", "a/b/c", "a/b/c/d"], ["a/bc", "a", "x/a/b"]),
        ("a/+/c", ["a/b/c", "a//c"], ["a/b/d", "a/b/x/c"]),
        ("#", ["a", "a/b"], []),
        ("a.b/+", ["a.b/c"], ["axb/c"]),
    ],
)
def test_topics(spark, pattern, yes, no):
    df = spark.createDataFrame([(t,) for t in yes + no], "topic string")
    assert sorted(r.topic for r in intake.matching_topics(df, pattern).collect()) == sorted(yes)


def test_receipt_stamp(spark):
    df = spark.createDataFrame([(1, None)], "x int, received_at timestamp")
    assert intake.stamp_receipt(df).first().received_at is not None
    assert intake.stamp_receipt(df.drop("received_at")).first().received_at is not None


def live(spark):
    rows = [
        (1, "A", "Solar", "NSW", 1.005, 5.0, 10.0, 0.0),
        (2, "B", "['Landfill Gas']", "VIC", 2.0, 0.0, -4.0, 100.0),
        (3, "A", "Black Coal", "NSW", 3.0, 1.0, 20.0, 50.0),
        (4, "C", "Unknown", "WA", 0.0, 0.0, 30.0, 0.0),
        (5, "", "Gas", "WA", 9.0, 9.0, 9.0, 9.0),
    ]
    df = spark.createDataFrame(
        rows, "arrival_seq long, facility_code string, fuel_list string, state string, power_value double, "
        "emission_value double, price_per_mwh double, demand_mw double"
    )
    return df.withColumns({
        "facility_name": F.col("facility_code"), "lat": F.lit(1.0), "lng": F.lit(2.0), "timestamp": F.lit("t"),
        "received_us": F.col("arrival_seq") * 3_600_000_000, "received_at": F.timestamp_seconds(F.col("arrival_seq") * 3600),
    })


def test_snapshot_and_kpis(spark):
    last = snapshot.latest_snapshot(live(spark))
    assert sorted((r.facility_code, r.arrival_seq) for r in last.collect()) == [("A", 3), ("B", 2), ("C", 4)]
    want = {"facility_count": 3, "total_power": 5.0, "total_emission": 1.0, "median_price": 25.0, "median_demand": 75.0}
    assert snapshot.snapshot_kpis(last).first().asDict() == want
    assert snapshot.store_kpis(last).first().asDict() == want
    none = last.filter("false")
    assert set(snapshot.snapshot_kpis(none).first()) == set(snapshot.store_kpis(none).first()) == {0}
    pick = lambda fuel, region: sorted(r.facility_code for r in snapshot.filter_snapshot(last, fuel, region).collect())
    assert pick("All", "All") == ["A", "B", "C"] and pick("Coal", "All") == ["A"]
    assert pick("Gas", "VIC") == ["B"] and pick("Gas", "NSW") == []
    arrays = last.withColumn("fuel_list", F.array("fuel_list", F.lit(None)))
    assert [r.facility_code for r in snapshot.filter_snapshot(arrays, "Gas").collect()] == ["B"]


def test_store_and_latest(spark):
    df = live(spark)
    assert sorted(r.arrival_seq for r in snapshot.last_messages(df, 2).collect()) == [4, 5]
    assert snapshot.last_messages(df, 0).count() == 0
    assert snapshot.latest_message(df).first().arrival_seq == 5
    assert snapshot.preview(snapshot.latest_snapshot(df)).columns == list(snapshot.PREVIEW)


def test_map_and_fingerprint(spark):
    last = snapshot.latest_snapshot(live(spark))
    points = {r.facility_code: r for r in snapshot.map_points(last, "emission_value").collect()}
    assert [points[c].colour for c in "ABC"] == ["red", "orange", "red"]
    assert points["A"].tooltip == "A | Emissions: 1.0 tCO2e" and points["A"].value == 1.0
    key = lambda df: snapshot.fingerprint(df).first().digest
    assert key(last) == key(last.repartition(7).withColumn("power_value", F.lit(1.0)))
    assert key(last) != key(last.withColumn("lat", F.lit(1.00002)))
    assert key(last.filter("false")) == "0"


def test_reset_and_status(spark):
    df = live(spark)
    assert sorted((r.arrival_seq, r.epoch) for r in snapshot.since_reset(df, hours=2).collect()) == [(5, 2)]
    assert snapshot.since_reset(df, hours=0).count() == 5
    status = snapshot.stream_status(df, n=3, hours=3, region="WA").first()
    assert status.asDict() == {
        "total_messages": 5, "messages_since_reset": 2, "store_size": 2, "last_update_us": 18_000_000_000,
        "last_reset_us": 14_400_000_000, "seconds_since_reset": 3600.0, "facilities": 1, "facilities_shown": 1,
    }


def test_trend(spark):
    frame = trend.trend_frame(live(spark).drop("demand_mw"))
    assert {r.demand_mw for r in frame.collect()} == {0.0}
    scaled = trend.trend_scaled(frame, tail=3).collect()
    assert {(r.metric, r.place): (r.x, r.y) for r in scaled}[("price_per_mwh", 1)] == (0.5, 1.0)
    assert min(r.y for r in scaled) == 0.0 and len(scaled) == 12
    ticks = trend.trend_ticks(frame, tail=3).collect()
    assert [(r.place, r.value, r.label) for r in ticks if r.axis == "y"] == [
        (0, 30.0, "30"), (1, 22.5, "22"), (2, 15.0, "15"), (3, 7.5, "8"), (4, 0.0, "0")]
    assert sorted((r.place, r.label) for r in ticks if r.axis == "x") == [(0, "03:00:00"), (1, "04:00:00"), (2, "05:00:00")]
    flat = frame.withColumns({m: F.lit(4.0) for m in ("power_value", "emission_value", "price_per_mwh", "demand_mw")})
    one = trend.trend_ticks(flat, tail=1).collect()
    assert [r.value for r in one if r.axis == "y"] == [5.0, 4.75, 4.5, 4.25, 4.0] and not [r for r in one if r.axis == "x"]
    assert {(r.x, r.y) for r in trend.trend_scaled(flat, tail=1).collect()} == {(0.0, 0.0)}
    assert trend.trend_scaled(frame.filter("false")).count() == trend.trend_ticks(frame.filter("false")).count() == 0


MS = 1_000_000


def deliveries(spark, steps, sent=None, seqs=None):
    at, rows = 0, []
    for i, step in enumerate(steps):
        at += step
        rows.append((i, f"t/{i % 2}", at, seqs[i] if seqs else i + 1, sent[i] if sent else None))
    return spark.createDataFrame(rows, "arrival_seq long, topic string, arrival_ns long, seq long, sent_mono_ns long").repartition(3)


def test_verdicts(spark):
    ok = lambda df: cadence.cadence_verdict(df).first()
    assert ok(deliveries(spark, [100 * MS] * 101)).asDict() == {"scope": "arrival", "n": 100, "within": 100, "verdict": "PASS"}
    assert ok(deliveries(spark, [100 * MS] * 95 + [130 * MS] * 6)).verdict == "FAIL"
    assert ok(deliveries(spark, [80 * MS] * 96 + [121 * MS] * 5)).verdict == "PASS"
    assert ok(deliveries(spark, [1])).asDict() == {"scope": None, "n": None, "within": None, "verdict": "INDETERMINATE"}
    sent = [i * 100 * MS for i in range(20)]
    assert ok(deliveries(spark, [500 * MS] * 20, sent)).asDict() == {"scope": "sender", "n": 19, "within": 19, "verdict": "PASS"}
    assert ok(deliveries(spark, [100 * MS] * 3, [None, 5, None])).scope == "arrival"


def test_report(spark):
    sent = [0, 100 * MS, 50 * MS, None, 150 * MS]
    df = deliveries(spark, [0, 100 * MS, 120 * MS, 90 * MS, 300 * MS], sent)
    rows = {(r.scope, r.topic): r for r in cadence.cadence_report(df).collect()}
    assert set(rows) == {("sender", None), ("arrival", None), ("topic", "t/0"), ("topic", "t/1")}
    assert (rows["sender", None].n, rows["sender", None].min_s, rows["sender", None].max_s) == (3, -0.05, 0.1)
    arrival = rows["arrival", None]
    assert (arrival.n, arrival.mean_s, arrival.p50_s, arrival.within_pct) == (4, pytest.approx(0.1525), pytest.approx(0.11), 75.0)
    assert arrival.p90_s == pytest.approx(0.246) and rows["topic", "t/1"].n == 1


def test_sequence_and_sample(spark):
    df = deliveries(spark, [1] * 8, seqs=[1, 2, 4, 4, 5, 1, 2, 3])
    gaps = cadence.sequence_gaps(df).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.seq, r.previous_seq) for r in gaps] == [(2, 4, 2), (3, 4, 4), (5, 1, 5)]
    long = deliveries(spark, [10_000 * MS] * 10)
    assert cadence.sample_window(long).count() == 7


BODIES = {
    # Shown: a field that is not needed may be of any type.
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"seq":"x"}': None,
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"seq":1.0}': None,
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"seq":100000000000000000000}': None,
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"sent_mono_ns":1.5}': None,
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"slot_mono_ns":"a"}': None,
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3,"unit":"MW"}': None,
    '\n\t {"facility_code":" \\tA\\n","lat":1,"lng":2,"power_value":3}\r\n': None,
    # Not shown.
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3} tail': "invalid_json",
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3}]': "invalid_json",
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3}] {}': "invalid_json",
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3},{}': "invalid_json",
    '{"facility_code":"A","lat":1,"lng":2,"power_value":3}}': "invalid_json",
    "{'facility_code':'A','lat':1,'lng':2,'power_value':3}": "invalid_json",
    '{"facility_code":"A","lat":1,"lng":2': "invalid_json",
    "5": "invalid_json",
    "": "invalid_json",
    "\n[1]": "not_object",
}


def test_bodies(spark):
    rows = [(i, "t", body, i) for i, body in enumerate(BODIES)]
    raw = spark.createDataFrame([*rows, (99, "t", None, 99)], "arrival_seq long, topic string, body string, arrival_ns long")
    bad = {r.arrival_seq: r.reason for r in intake.quarantined_messages(raw).collect()}
    want = {i: reason for i, reason in enumerate(BODIES.values()) if reason}
    assert bad == want | {99: "invalid_json"}
    shown = intake.normalize_messages(raw).collect()
    assert {r.arrival_seq for r in shown} == set(range(len(BODIES))) - set(want)
    assert {r.facility_code for r in shown} == {"A"}
    captured = {r.arrival_seq: (r.seq, r.sent_mono_ns) for r in intake.captured_messages(raw).collect()}
    assert len(captured) == len(rows) + 1 and captured[1] == (1, None) and captured[3] == (None, 1)
