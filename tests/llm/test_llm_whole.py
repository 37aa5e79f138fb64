"""That the registered queries and operators do the whole job."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, secret_scan, toxicity
from tidemark.llm.queries import QUERIES, SHARES

from .test_llm_cases import letters  # noqa: F401

SF = "/root/testdata/sf0.001"


# -- 1 mixing ------------------------------------------------------------------


def test_mix_query_is_in_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(docs, SHARES).collect()
    first = {r.doc_id: min((t.position for t in r.repeats), default=None) for r in mixed}
    words = {r.doc_id: sum(t.words for t in r.repeats) for r in mixed}
    got = QUERIES["op1_mix_sources"](spark, SF).collect()
    assert len(got) == len(mixed) and {r.doc_id: r.taken for r in got} == words
    assert None in first.values() and len(set(first.values())) > len(got) / 4
    want = sorted(first, key=lambda d: (first[d] is None, first[d] or 0, d))
    assert [r.doc_id for r in got] == want


def test_taken_in_order_odd(odd, empty):
    """Repeated rows and ids, and documents without words, each keep a row."""
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    got = mixing.taken_in_order(odd, SHARES)
    want = mixing.mix(odd, SHARES)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    places = [r.position for r in got.collect()]
    assert [p is None for p in places] == sorted(p is None for p in places)
    taken = [p for p in places if p is not None]
    assert taken and taken == sorted(taken)
    assert got.filter((F.col("taken") == 0) != F.col("position").isNull()).count() == 0
    assert mixing.taken_in_order(empty, SHARES).count() == 0


def test_texts_are_not_shuffled(spark, frame):
    """Neither the mix nor the scan carries texts that the caller does not keep."""
    docs = frame([(1, "some words", "a"), (2, "token=abcdefghijklmnop", "b")])
    mixed = mixing.mix(docs, SHARES, keep=("doc_id",))
    assert "text" not in mixed.columns and set(mixed.columns) >= {"doc_id", "taken", "repeats"}
    found = secret_scan.scan(docs, keep=("doc_id",))
    assert found.columns == ["doc_id", "base", "spans"] and found.count() == 2
    for df in (mixed, found):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "struct(doc_id" in plan and not re.search(r"struct\([^)]*\btext, ", plan)


# -- 5 toxicity ----------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    """A character model that has seen nothing, so where words end is a guess."""
    return toxicity.CharacterModel.from_counts(np.zeros(toxicity.SYMBOLS**3, dtype=np.int64))


def features_of(text, model):
    found = list(toxicity.features([text], toxicity.Reader(model)))
    return set(np.concatenate([h for _, h, _ in found]).tolist())


@pytest.mark.parametrize("before", [3, 64, 65, 500, 5000])
def test_words_anywhere_in_a_spaced_run(plain, before):
    """Also behind letter 64, as word endings and their beginnings."""
    run = " ".join("xy" * before + "moronsé" + "zq" * 40)
    found = features_of(f"so {run}, now", plain)
    for ending in ["moronsé" + "zq" * 40, "zq" * 40, "zqzq"]:
        assert features_of(ending, plain) <= found


def test_ending_features_are_those_of_words(plain):
    for word in ["abcd", "àbcdéfgh", "w" * 63, "w" * 64, "w" * 65, "abcé" * 50]:
        want = set()
        for i in range(len(word) - 3):
            text = (word[i:] + " ").encode()
            starts, whole, parts = toxicity.word_parts(text, toxicity.ALNUM, toxicity.PREFIXES)
            if len(text) - 1 <= toxicity.LONG:
                want |= set(toxicity.mixed(whole ^ np.uint64(1)).tolist())
            for n, (_, part) in zip(toxicity.PREFIXES, parts):
                want |= set(toxicity.mixed(part ^ np.uint64(n)).tolist())
        got = set(toxicity.ending_features(word).tolist())
        assert want <= got
        assert len(got - want) <= max(0, len(word.encode()) - toxicity.LONG)


@pytest.mark.parametrize(
    "written", ["you,1d10t", "what/1d10t", "<b>1d10t</b>", "you_1d10t", "a.b/1d10t;now", "you!1d10t", "so|$tup1d", "x,stuuupid,y"]
)
def test_disguised_words_that_touch_others(letters, written):  # noqa: F811
    found = toxicity.Reader(letters).words(f"oh {written} there")
    assert "idiot" in found or "stupid" in found


# -- 9 near duplicates ---------------------------------------------------------


def test_rows_of_one_id_are_dropped_by_text(frame):
    copied = "one two three four five six seven eight nine ten"
    own = "quite another text that is nowhere else in this table at all"
    docs = frame([(1, copied, "a"), (5, copied, "a"), (5, own, "a"), (5, None, "a"), (7, own, "b")])
    left = ngram_join.drop_near_duplicates(docs, ngram_join.Rule(k=3, percent=80))
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(1, copied), (5, ""), (5, own)]
