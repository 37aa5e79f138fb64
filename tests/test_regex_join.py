"""The regular-expression join through required pieces, against trying every pair."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import align


@pytest.mark.parametrize(
    "pattern,pieces",
    [
        ("abcd", ["abcd"]),
        ("ab.cdef", ["cdef"]),
        ("abcd?efgh", ["efgh"]),
        ("abcde*", ["abcd"]),
        ("abcd+ef", ["abcd"]),
        ("abcd{0,2}ef", ["abc"]),
        (r"ab\.cd\[x", ["ab.cd[x"]),
        (r"a\\bcd", [r"a\bcd"]),
        ("(abc)?defg", ["defg"]),
        ("(abc|def)ghi", ["ghi"]),
        ("abc|defg", ["abc", "defg"]),
        ("abc|d", None),
        ("abc|abc", ["abc"]),
        ("^abc$", ["abc"]),
        ("x[abc]+yzz", ["yzz"]),
        ("[]abc]def", ["def"]),
        (r"\d+ kW", [" kW"]),
        (r"\p{L}abc", None),
        ("(?i)abcd", None),
        (r"\Qab.cd\E", None),
        (r"\x41bcd", None),
        (r"(abc)def\1", None),
        ("((((((abc))))))def", None),
        ("(?:abc)+def", ["def"]),
        ("ab", None),
        (".*", None),
        ("", None),
        ("été+", ["été"]),
        ("abc|", None),
    ],
)
def test_required_pieces(spark, pattern, pieces):
    got = spark.createDataFrame([(pattern,)], "p string").select(align.required_literals(F.col("p"))).first()[0]
    assert (got and sorted(got)) == (pieces and sorted(pieces))


def frames(spark, patterns, texts):
    left = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], "k int, n string")
    right = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return left, right


def pairs(df):
    return sorted(tuple(r) for r in df.select("k", "id").collect())


def test_against_every_pair(spark):
    """Random expressions over few letters, so that most parts of the grammar meet real matches."""
    rng = random.Random(7)
    atoms = ["a", "b", "ab", "abb", "bab", "[ab]", "[^b]", ".", r"\.", r"\w", r"\d", "(a|b)", "(ab)", "(?:ba)", "é", r"\+", "^", "$", r"\bab"]
    times = ["", "", "", "", "?", "*", "+", "{2}", "{0,1}", "+?", "*?"]

    def pattern():
        parts = ["".join(rng.choice(atoms) + rng.choice(times) for _ in range(rng.randrange(1, 5))) for _ in range(rng.choice((1, 1, 1, 2, 3)))]
        return "|".join(parts).replace("^?", "^").replace("$?", "$")

    patterns = []
    while len(patterns) < 400:
        p = pattern()
        if not any(f"{anchor}{t}" in p for anchor in ("^", "$") for t in "?*+{"):
            patterns.append(p)
    patterns += ["aba", "ab.b", None, "", "aba", "(?i)ABA"]
    texts = ["".join(rng.choice("aabbb.é+1 ") for _ in range(rng.randrange(0, 14))) for _ in range(120)] + [None, "", "abab", "abab"]
    left, right = frames(spark, patterns, texts)
    want = left.join(right, F.expr("t rlike n"))
    assert pairs(align.contains_join(left, right, "n", "t", regex=True)) == pairs(want)


def test_no_nested_loop_with_pieces(spark):
    left, right = frames(spark, ["Alpha (North|South)", "Beta.?Gamma", "plain name", r"Delta\d+"], ["x Alpha North y", "BetaGamma", "a plain name", "Delta7"])
    joined = align.contains_join(left, right, "n", "t", regex=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert pairs(joined) == [(i, i) for i in range(4)]
    outer = align.contains_join(left, right.limit(1), "n", "t", how="left", regex=True)
    assert sorted((r.k, r.id) for r in outer.collect()) == [(0, 0), (1, None), (2, None), (3, None)]
