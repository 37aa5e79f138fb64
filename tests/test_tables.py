"""Landed sources, cleaning, roll-up, publishing."""

import json

from pyspark.sql import functions as F

from tidemark.operators import clean, publish, rollup
from tidemark.plans import prepare
from tidemark.session import new_folder
from tidemark.sources import landed, sinks


def test_facility_dimension_from_files(spark, tmp_path):
    body = {"data": [{"code": "A", "name": "Alpha, \"x\"", "location": {"lat": -1.5, "lng": 2.0}}, {"code": "B", "name": "Beta"}]}
    (tmp_path / "one.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"data": []}))
    rows = landed.facility_dimension(landed.read_responses(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in rows] == [("A", 'Alpha, "x"', -1.5, 2.0), ("B", "Beta", None, None)]
    out = new_folder(spark, "csv")
    sinks.write_csv(landed.facility_dimension(landed.read_responses(spark, str(tmp_path))), out)
    again = landed.read_csv(spark, out, "facility_code string, facility_name string, lat double, lng double")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def response(*units):
    return json.dumps({"data": [{"results": [{"name": n, "data": pts} for n, pts in group]} for group in units]})


def test_series_to_measures(spark):
    url = "https://h/d?facility_code=A&metrics=power&metrics=emissions&interval=5m"
    body = response(
        [("u1", [["2025-10-25T00:00:00", 1.5], ["2025-10-25T00:05:00", None]]), ("u2", [[1761310800000, 2.0], ["2025-10-05T02:30:00", 9]])],
        [("u1", [["2025-10-25T00:10:00+11:00", "3"]])],
    )
    market = response([("p", [["2025-10-25T00:00:00", -7.0]])], [("d", [["2025-10-25T00:00:00", 100]])])
    df = spark.createDataFrame(
        [("A", body, url), ("A", market, url.replace("power", "price").replace("emissions", "demand")), ("A", "{bad", url)],
        "facility_code string, body string, url string",
    )
    points, bad = prepare.bronze(df)
    # The broken body leaves a row for each metric that was asked for.
    found = sorted((r.time_text or "", r.metric, r.problem) for r in bad.collect())
    broken = [("", m, "unreadable_body") for m in ("emissions", "power")]
    assert found == [*broken, ("2025-10-05T02:30:00", "power", "gap")]
    merged = rollup.metric_table(points).orderBy("ts").collect()
    got = [(r.power_value, r.emission_value, r.price_per_mwh, r.demand_mw) for r in merged]
    # Only missing values sum to 0; an absent metric is NULL.
    assert got == [(3.5, None, -7.0, 100.0), (0.0, None, None, None), (None, 3.0, None, None)]


def test_outer_merge_keeps_the_other_side(spark):
    one = spark.createDataFrame([("A", 1, 2.0)], "f string, ts int, p double")
    none = spark.createDataFrame([], "f string, ts int, q double")
    assert [tuple(r) for r in rollup.outer_merge(one, none, ["f", "ts"]).collect()] == [("A", 1, 2.0, None)]
    assert rollup.union_frames(one, none).columns == ["f", "ts", "p", "q"]


def test_missing_requests(spark):
    cols = "source string, facility_code string, date_start string, date_end string"
    wanted = spark.createDataFrame([("facility", "A", "1", "2"), ("market", "A", "1", "2")], cols)
    held = spark.createDataFrame([("market", "A", "1", "2"), ("market", "A", "1", "2")], cols)
    assert [r.source for r in landed.missing_requests(wanted, held).collect()] == ["facility"]


NAN = float("nan")


def test_clean_measures(spark):
    rows = [
        ("A", 1, -5.0, None), ("A", 2, None, None), ("A", 3, 9.0, 1.0), ("A", 4, NAN, 2.0),
        ("B", 1, None, None), ("B", 2, NAN, None),
        ("C", 1, None, 3.0), ("C", 2, None, None), (None, 1, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "facility_code string, ts int, power_value double, emission_value double")
    out = clean.clean_measures(df, slices=4).orderBy("facility_code", "ts").collect()
    assert [(r.facility_code, r.ts, r.power_value, r.emission_value) for r in out] == [
        ("A", 1, 0.0, None), ("A", 2, 9.0, 1.0), ("A", 3, 9.0, 1.0), ("A", 4, None, 2.0),
        ("C", 1, None, 3.0), ("C", 2, None, None),
    ]
    prof = clean.quality_profile(clean.without_nan(df, ["power_value"]), "facility_code").first()
    assert (prof.power_value_negative_before, prof.power_value_negative_after, prof.power_value_missing, prof.entities, prof.rows) == (1, 0, 6, 3, 9)


def test_table_sink_builds_once(spark):
    path = new_folder(spark, "sink")
    df = spark.range(10).withColumn("event_date", (F.col("id") % 2).cast("string"))
    sinks.write_once(df, path, "event_date")
    sinks.write_once(df.limit(1), path, "event_date")
    assert spark.read.parquet(path).count() == 10
    sinks.write_table(df.limit(3), path, "event_date")
    assert spark.read.parquet(path).count() == 3


def publish_rows(spark):
    rows = [(t, f"F{c}", f"Zürich {c}", float(t * c) if c else None) for t in range(20) for c in range(5)]
    return spark.createDataFrame(rows, "ts int, facility_code string, facility_name string, power_value double").repartition(4)


def test_publish_order_and_cursor(spark):
    rows = publish_rows(spark)
    seq = publish.publish_sequence(rows, slices=8).orderBy("seq").collect()
    assert [r.seq for r in seq] == list(range(1, 101))
    assert [(r.ts, r.facility_code) for r in seq] == sorted((t, f"F{c}") for t in range(20) for c in range(5))
    later = publish.after_cursor(rows, F.lit(7), "F2").collect()
    assert sorted((r.ts, r.facility_code) for r in later)[:3] == [(7, "F3"), (7, "F4"), (8, "F0")]
    assert publish.after_cursor(rows, None).count() == 100
    resumed = publish.publish_sequence(publish.after_cursor(rows, F.lit(18), "F4"), first=96, slices=2)
    assert sorted(r.seq for r in resumed.collect()) == [96, 97, 98, 99, 100]


def test_publish_payload(spark):
    sent = publish.publish_messages(publish.replay_schedule(publish.publish_sequence(publish_rows(spark)), 10), "plant")
    one = json.loads(sent.filter("seq = 1").first().body)
    assert one["facility_name"] == "Zürich 0" and "ü" in sent.filter("seq = 1").first().body
    assert one["power_value"] is None and one["unit"] == {"power_value": "MW", "emission_value": "tCO2e"}
    assert one["slot_mono_ns"] == 10 + 100_000_000 and sent.filter("seq = 1").first().topic == "plant/F0"


def test_prepare_run(spark):
    url = "https://h/d?metrics=power&metrics=emissions"
    pts = [[f"2025-10-25T00:{m:02d}:00", None if m == 10 else m - 5] for m in range(0, 30, 5)]
    df = spark.createDataFrame(
        [(c, response([("u", pts)], [("u", pts)]), url) for c in ("A", "B", "Z")], "facility_code string, body string, url string"
    )
    aligned = spark.createDataFrame(
        [("A", "Alpha", 1.0, 2.0, "NSW", ["Gas"]), ("A", "Alpha", 1.0, 2.0, "ACT", ["Gas"]), ("B", "Beta", 1.0, 2.0, "VIC", [None])],
        "facility_code string, facility_name string, lat double, lng double, state string, fuel_list array<string>",
    )
    target = new_folder(spark, "prepare")
    prepare.run(df, aligned, target)
    out = spark.read.parquet(f"{target}/publish").orderBy("seq").collect()
    assert [r.seq for r in out] == list(range(1, 19))
    assert [(r.facility_code, r.state) for r in out[:3]] == [("A", "ACT"), ("A", "NSW"), ("B", "VIC")]
    assert [r.power_value for r in out if r.state == "VIC"] == [0.0, 0.0, 0.0, 10.0, 15.0, 20.0]


def test_prepare_all(spark):
    url = "https://h/d?metrics=power&metrics=emissions"
    pts = [[f"2025-10-25T00:{m:02d}:00", m] for m in range(0, 30, 5)]
    responses = spark.createDataFrame(
        [(c, response([("u", pts)], [("u", pts)]), url) for c in ("A", "B")] + [("B", "{broken", url)],
        "facility_code string, body string, url string",
    )
    body = json.dumps({"data": [{"code": "A", "name": "Alpha", "location": {"lat": 1, "lng": 2}}, {"code": "B", "name": "Beta"}]})
    facilities = spark.createDataFrame([(body,), ("{broken",)], "body string")
    register = spark.createDataFrame(
        [("Big Alpha Plant", "NSW", "Gas", 1), ("Alpha two", "NSW", "Solar", 2)],
        "register_name string, state string, primary_fuel string, position int",
    )
    planned = spark.createDataFrame([("Alpha next", "Wind", 1)], "planned_name string, future_fuel string, position int")
    ts = F.lit("2025-10-24T13:05:00Z").cast("timestamp")
    market = spark.range(1).select(ts.alias("ts"), F.lit(50.0).alias("price_per_mwh"), F.lit(9.0).alias("demand_mw"))
    target = new_folder(spark, "prepare_all")
    prepare.run_all(responses, facilities, register, planned, target, market)
    sent = [json.loads(r.body) for r in spark.read.parquet(f"{target}/messages").orderBy("seq").collect()]
    assert [m["seq"] for m in sent] == [1, 2, 3, 4, 5, 6] and {m["facility_code"] for m in sent} == {"A"}
    assert sent[0]["timestamp"] == "2025-10-25T00:00:00+11:00" and sent[0]["fuel_list"] == ["Gas", "Solar", "Wind", "Wind"]
    assert [m["price_per_mwh"] for m in sent] == [None, 50.0, None, None, None, None]
    assert spark.read.parquet(f"{target}/facility_quarantine").count() == 1
    assert [r.problem for r in spark.read.parquet(f"{target}/quarantine").collect()] == ["unreadable_body"] * 2
