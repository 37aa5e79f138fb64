"""Containment joins against brute force; alignment on hand-made registers."""

import random

import pytest

from tidemark.operators import align


def brute(names, texts):
    return sorted((n, i) for n in set(names) if n is not None for i, t in texts if t is not None and n in t)


def random_case(seed):
    rnd = random.Random(seed)
    words = ["Solar", "Wind", "Farm", "Snowy 2.0", "North", "a", "Été", "🌞x", "Stage", "II", "-", "B+C", "(x)"]
    names = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 9))) for _ in range(60)]
    names += ["Common prefix of every long station name, unit %d" % i for i in range(30)]
    names += ["a", "ab", "Sol", "ola", "é", "", None, "Solar", "Solar"]
    texts = []
    for i in range(150):
        parts = [rnd.choice([*words, *[n for n in names if n]]) for _ in range(rnd.randrange(1, 12))]
        texts.append((i, rnd.choice([" ", "\n", ""]).join(parts)))
    hot = texts[0][1] * 40
    texts += [(150 + i, hot) for i in range(70)] + [(500, None), (501, ""), (502, "Solar")]
    return names, texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [align.BROADCAST_LIMIT, 0])
def test_contains_join_equals_brute_force(spark, seed, limit):
    names, texts = random_case(seed)
    left = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "k int, n string").repartition(3)
    right = spark.createDataFrame(texts, "id int, t string").repartition(4)
    want = brute(names, texts)
    pairs = align.containing_texts(left, right, "n", "t", limit).select("_name", "id").collect()
    assert sorted(map(tuple, pairs)) == want

    per_name = {}
    for n, i in want:
        per_name.setdefault(n, []).append(i)
    rows = align.contains_join(left, right, "n", "t", "left", limit).select("k", "id").collect()
    expected = [(k, i) for k, n in enumerate(names) for i in (per_name.get(n) or [None])]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_no_names(spark):
    left = spark.createDataFrame([(None,)], "n string")
    right = spark.createDataFrame([("x",)], "t string")
    assert align.contains_join(left, right, "n", "t").count() == 0
    assert align.contains_join(left, right, "n", "t", "left").collect()[0].t is None


def test_common_beginning_shares_probes(spark):
    names = spark.createDataFrame([("Common prefix of every long station name, unit %04d" % i,) for i in range(500)], "_name string")
    probes = align._name_probes(names, 12)
    assert probes.count() == 12


def registers(spark):
    facilities = spark.createDataFrame(
        [
            (0, "F1", "Alpha", 1.0, 2.0),
            (1, "F2", "Beta", 3.0, 4.0),
            (2, "F3", "Gamma", None, None),
            (3, "F4", "Delta", 5.0, 6.0),
        ],
        "position int, facility_code string, facility_name string, lat double, lng double",
    )
    register = spark.createDataFrame(
        [
            (0, "Alpha One", "NSW", "Gas"),
            (1, "Alpha One", "NSW", "Gas"),
            (2, "The Alpha plant", "NSW", "Wind"),
            (3, "Alpha", "ACT", None),
            (4, "Beta", None, "Coal"),
            (5, "Gamma", "VIC", "Coal"),
            (6, "alpha lower", "VIC", "Hydro"),
            (7, None, "VIC", "Hydro"),
        ],
        "position int, register_name string, state string, primary_fuel string",
    )
    planned = spark.createDataFrame(
        [(0, "New Alpha", "Solar"), (1, "Alpha 2", "Battery"), (2, "Alpha 3", "Solar"), (3, "Alpha 4", None)],
        "position int, planned_name string, future_fuel string",
    )
    return facilities, register, planned


def test_align_entities(spark):
    out = align.align_entities(*registers(spark)).collect()
    got = {(r.facility_code, r.state): r.fuel_list for r in out}
    # Distinct (primary, future) pairs in order: each future fuel repeats per primary fuel.
    assert got == {
        ("F1", "NSW"): ["Gas", "Gas", "Gas", "Wind", "Wind", "Wind", "Solar", "Battery", "Solar", "Battery"],
        ("F1", "ACT"): [None, None, None, "Solar", "Battery"],
    }


def test_enrich_fans_out_or_not(spark):
    aligned = align.align_entities(*registers(spark))
    measures = spark.createDataFrame([("F1", 1), ("F1", 2), ("F9", 3)], "facility_code string, ts int")
    assert align.enrich(measures, aligned).count() == 4
    kept = align.enrich(measures, aligned, dedupe=True).collect()
    assert sorted((r.ts, r.state) for r in kept) == [(1, "ACT"), (2, "ACT")]
