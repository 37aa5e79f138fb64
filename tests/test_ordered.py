"""Sliced windows against plain sequential loops, with hot keys and odd orders."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.distribution import distribution


def sequential_half_fill(values):
    out, n, i = list(values), len(values), 0
    while i < n:
        if values[i] is not None:
            i += 1
            continue
        j = i
        while j < n and values[j] is None:
            j += 1
        before = values[i - 1] if i else None
        after = values[j] if j < n else None
        half = (j - i) // 2
        for k in range(i, j):
            out[k] = before if k - i < half else after
        i = j
    return out


def carry_on(values):
    out, last = [], None
    for v in values:
        last = last if v is None else v
        out.append(last)
    return out


def random_rows(seed, n=1500, hot=0.34, keys=25, missing=0.5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else f"k{rnd.randrange(keys)}"
        v = None if key == "k0" or rnd.random() < missing else float(rnd.randrange(100))
        w = None if rnd.random() < 0.97 else float(i)
        rows.append((key, i, v, w))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module", params=[1, 29])
def case(request, spark):
    rows = random_rows(request.param)
    df = spark.createDataFrame(rows, "k string, t long, v double, w double").repartition(5)
    return request.param, df, sorted(rows)


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return groups


def test_number_rows(case):
    slices, df, rows = case
    got = ordered.number_rows(df, ["t"], name="n", slices=slices).select("t", "n").collect()
    assert sorted((r.t, r.n) for r in got) == [(i, i + 1) for i in range(len(rows))]
    got = ordered.number_rows(df, ["t"], by=["k"], name="n", slices=slices).collect()
    want = {(k, r[1]): i + 1 for k, rs in by_key(rows).items() for i, r in enumerate(rs)}
    assert {(r.k, r.t): r.n for r in got} == want


def test_number_rows_ties_in_first_column(spark):
    rows = [(5 if i % 3 else i, f"c{i:04d}") for i in range(900)]
    df = spark.createDataFrame(rows, "t long, c string").repartition(4)
    got = ordered.number_rows(df, ["t", "c"], name="n", slices=16).collect()
    assert [(r.t, r.c) for r in sorted(got, key=lambda r: r.n)] == sorted(rows)


def test_previous_values(case):
    slices, df, rows = case
    for by in ([], ["k"]):
        got = ordered.previous_values(df, ["t"], {"pt": "t", "pv": "v"}, by=by, slices=slices)
        groups = by_key(rows).values() if by else [sorted(rows, key=lambda r: r[1])]
        want = {}
        for rs in groups:
            last = (None, None)
            for r in rs:
                want[r[1]] = last
                last = (r[1], r[2])
        assert {r.t: (r.pt, r.pv) for r in got.collect()} == want


def test_fills(case):
    slices, df, rows = case
    names = {"fv": "v", "fw": "w"}
    half = {r.t: (r.fv, r.fw) for r in ordered.fill_gaps(df, ["t"], names, ["k"], slices).collect()}
    fwd = {r.t: (r.fv, r.fw) for r in ordered.fill_forward(df, ["t"], names, ["k"], slices).collect()}
    bwd = {r.t: (r.fv, r.fw) for r in ordered.fill_backward(df, ["t"], names, ["k"], slices).collect()}
    assert len(half) == len(fwd) == len(bwd) == len(rows)
    for rs in by_key(rows).values():
        for at in (0, 1):
            values = [r[2 + at] for r in rs]
            filled = sequential_half_fill(values)
            ff, bf = carry_on(values), carry_on(values[::-1])[::-1]
            for i, r in enumerate(rs):
                assert half[r[1]][at] == filled[i]
                assert fwd[r[1]][at] == ff[i]
                assert bwd[r[1]][at] == bf[i]


GAP_RULES = [
    ([1, None, 9], [1, 9, 9]),
    ([1, None, None, 9], [1, 1, 9, 9]),
    ([1, None, None, None, 9], [1, 1, 9, 9, 9]),
    ([None, None, 9], [None, 9, 9]),
    ([1, None, None], [1, 1, None]),
    ([None, None, None], [None, None, None]),
]


@pytest.mark.parametrize("slices", [1, 12])
def test_gap_rules(spark, slices):
    rows = [(k, t, v) for k, (given, _) in enumerate(GAP_RULES) for t, v in enumerate(given)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = ordered.fill_gaps(df, ["t"], {"v": "v"}, ["k"], slices).orderBy("k", "t").collect()
    assert [r.v for r in got] == [v for _, want in GAP_RULES for v in want]


def test_null_order_and_key_values(spark):
    rows = [("a", None, 1), ("a", 1, None), ("a", 2, 3), (None, 1, 7), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = ordered.fill_forward(df, ["t"], {"f": "v"}, ["k"], slices=3).collect()
    assert {(r.k, r.t): r.f for r in got} == {("a", None): 1, ("a", 1): 1, ("a", 2): 3, (None, 1): 7, (None, 2): 7}
    back = ordered.fill_backward(df, ["t"], {"f": "v"}, ["k"], slices=3)
    assert {(r.k, r.t): r.f for r in back.collect()} == {("a", None): 1, ("a", 1): 3, ("a", 2): 3, (None, 1): 7, (None, 2): None}
    lagged = ordered.previous_values(df, ["t"], {"p": "v"}, ["k"], slices=3)
    assert {(r.k, r.t): r.p for r in lagged.collect()} == {("a", None): None, ("a", 1): 1, ("a", 2): None, (None, 1): None, (None, 2): 7}
    one = ordered.number_rows(spark.createDataFrame([(None,), (3,), (1,)], "t int"), ["t"], name="n", slices=4)
    assert {r.t: r.n for r in one.collect()} == {None: 1, 1: 2, 3: 3}


@pytest.mark.parametrize("slices", [1, 40])
def test_distribution_matches_builtin(spark, slices):
    rnd = random.Random(4)
    rows = [("a" if rnd.random() < 0.6 else f"b{rnd.randrange(9)}", rnd.randrange(200)) for _ in range(3000)]
    rows += [("one", 5), ("none", None)] + [("copies", 3)] * 2000
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    qs = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = distribution(
        df, "v", qs, ["g"], {"total": lambda v, n: F.sum(v * n)}, slices=slices
    ).collect()
    want = (
        df.filter("v is not null")
        .groupBy("g")
        .agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.percentile("v", list(qs.values())).alias("p"))
        .collect()
    )
    assert {r.g: (r.n, r.total, [r.p50, r.p90, r.p99]) for r in got} == {
        r.g: (r.n, r.total, pytest.approx(r.p)) for r in want
    }
    whole = distribution(df, "v", qs, slices=slices).first()
    assert whole.p50 == df.agg(F.percentile("v", 0.5)).first()[0]
    empty = distribution(df.filter("v < 0"), "v", qs, slices=slices).first()
    assert (empty.n, empty.p50) == (0, None)


@pytest.mark.parametrize("slices", [8192, 65536])
def test_many_slices(spark, slices):
    """More slices than an int product of slices and sample would allow."""
    rows = 1_000_000
    df = spark.range(rows).select(
        F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("t"), "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("v")
    )
    numbered = ordered.number_rows(df, ["t", "id"], name="n", slices=slices)
    total, low, high, different = numbered.agg(
        F.count(F.lit(1)), F.min("n"), F.max("n"), F.count_distinct("n")
    ).first()
    assert (total, low, high, different) == (rows, 1, rows, rows)
    if slices == 8192:
        whole = distribution(df.filter("v is not null"), "v", {"p50": 0.5}, slices=slices).first()
        values = sorted(range(0, rows, 3))
        assert whole.n == len(values) and whole.p50 == (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2


def test_last_known_before(spark):
    rows = [(i, None if i % 3 else i * 10) for i in range(50)] + [(50, None), (51, None), (52, 7)]
    df = spark.createDataFrame(rows, "t int, v int")
    want, last = {}, None
    for t, v in rows:
        want[t] = last
        last = v if v is not None else last
    for slices in (2, 9, 40):
        got = ordered.previous_values(df, ["t"], {"p": "v"}, slices=slices, known=("p",)).collect()
        assert {r.t: r.p for r in got} == want
