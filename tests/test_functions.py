"""Scalar and time helpers against Python's own behaviour."""

import math
import random

from pyspark.sql import functions as F

from tidemark.functions import frames, scalars, times


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, *names):
    rows = df.orderBy("i").select(*names).collect()
    return [r[0] if len(names) == 1 else tuple(r) for r in rows]


def test_rounding_equals_python(spark):
    rnd = random.Random(3)
    values = [2.675, 0.125, 1.005, 2.5, -2.675, -0.125, -1.005, 9.845, 0.0, 1e17, 1e300, -3.0, None]
    values += [rnd.randrange(-(10**6), 10**6) / 1000 for _ in range(3000)]
    values += [rnd.uniform(-1e4, 1e4) for _ in range(500)]
    df = column(spark, values, "double")
    want = [None if v is None else round(v, 2) for v in values]
    assert results(df.withColumn("r", scalars.round_value(F.col("x"))), "r") == want
    assert results(frames.round_columns(df, ["x"]), "x") == want
    five = [None if v is None else round(v, 5) for v in values]
    assert results(df.withColumn("r", scalars.round_value(F.col("x"), 5)), "r") == five


def test_tolerant_float(spark):
    texts = ["1_000", "1d", "1f", "1e3", " 5. ", ".5", "inf", "-Infinity", "", "  ", "1__0", "0x1", "1_", "NA", "1 2", "+-1", "e5", None]

    def python(x):
        try:
            return None if x in (None, "") else float(x)
        except ValueError:
            return None

    df = column(spark, texts)
    assert results(df.withColumn("v", scalars.tolerant_float(F.col("x"))), "v") == [python(t) for t in texts]
    nan = column(spark, ["nan", "NaN"]).withColumn("v", scalars.tolerant_float(F.col("x")))
    assert results(nan, "v") == [None, None]
    missing = column(spark, [" NA ", "N/A", "null", "None", "", "7"])
    assert results(missing.withColumn("v", scalars.float_or_missing(F.col("x"))), "v") == [None] * 5 + [7.0]


def test_lists_and_keys(spark):
    df = column(spark, ["['Gas', 'Solar']", '["Wind"]', "Gas", None])
    assert results(df.withColumn("v", scalars.list_from_text(F.col("x"))), "v") == [["Gas", "Solar"], ["Wind"], ["Gas"], None]
    keys = column(spark, ["facility|A|1|2", "A|1|2", "a|b|c|d|e"])
    out = keys.withColumn("v", scalars.request_key_parts(F.col("x")))
    assert [None if v is None else tuple(v) for v in results(out, "v")] == [("facility", "A", "1", "2"), None, None]
    url = column(spark, ["http://h/p?a=1&metrics=power&x=2&metrics=emissions", "http://h/p"])
    assert results(url.withColumn("v", scalars.query_values(F.col("x"), "metrics")), "v") == [["power", "emissions"], None]
    lists = spark.createDataFrame([(0, ["Coal", None]), (1, [None]), (2, None)], "i int, x array<string>")
    assert results(lists.withColumn("v", scalars.any_contains(F.col("x"), "oal")), "v") == [True, False, False]


def test_instants(spark):
    cases = {
        "2025-10-25T00:00:00": ("2025-10-25T00:00:00+11:00", None),
        "2025-10-25T00:00:00+10:00": ("2025-10-25T01:00:00+11:00", None),
        "2025-07-01 12:30:00": ("2025-07-01T12:30:00+10:00", None),
        "2025-10-25T00:00:00Z": ("2025-10-25T11:00:00+11:00", None),
        "1761350400000": ("2025-10-25T11:00:00+11:00", None),
        "1761350400000.0": ("2025-10-25T11:00:00+11:00", None),
        "2025-10-05T02:30:00": (..., "gap"),
        "2025-04-06T02:30:00": (..., "overlap"),
        "2025-04-06T03:00:00": ("2025-04-06T03:00:00+10:00", None),
        "2025-04-06T01:59:59": ("2025-04-06T01:59:59+11:00", None),
        "soon": (None, "unreadable"),
        None: (None, "unreadable"),
    }
    for session_zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            out = times.read_instants(column(spark, list(cases)), "x")
            got = results(out.withColumn("iso", times.iso_text(F.col("ts"))), "iso", "problem")
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        for (iso, problem), (want_iso, want_problem) in zip(got, cases.values()):
            assert problem == want_problem
            assert want_iso is ... or iso == want_iso


def test_wall_micros_round_trip(spark):
    df = column(spark, ["2024-01-01 00:00:07.179575", "1969-12-31 23:59:59.5", "2025-10-05 02:30:00"])
    df = df.withColumn("w", F.col("x").cast("timestamp_ntz"))
    df = df.withColumn("m", times.wall_micros(F.col("w"))).withColumn("b", times.wall_from_micros(F.col("m")))
    assert results(df, "m")[:2] == [1704067207179575, -500000]
    assert results(df, "b") == results(df, "w")
    back = column(spark, [1.5, 1704067207.179575], "double").withColumn("t", times.from_epoch_seconds(F.col("x")))
    assert results(back.withColumn("u", F.unix_micros("t")), "u") == [1500000, 1704067207179575]


def test_compute_once_parses_once(spark):
    df = column(spark, ['{"a": 1}', "x"])
    parsed = frames.compute_once(df, {"p": F.from_json("x", "a int")})
    plan = parsed.filter("p.a > 0 or p.a is null and p is not null").filter("p.a < 5")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert math.isclose(parsed.filter("p.a = 1").count(), 1)
