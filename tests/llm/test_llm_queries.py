"""Queries against their SQL, or against brute force where SQL cannot express them."""

import hashlib
import itertools
import re

import pytest

from tests import oracle
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(n) for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""


def test_winnowing(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op7_winnow_fingerprints"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, (d, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        edit = len(text) // 4
        edited = text[: len(text) - edit] + after[:edit]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1)
    by_text = {}
    for d, text in docs:
        by_text.setdefault(text, set()).add(got[d].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    # From the query's own columns: texts that share a run of the guaranteed length share an entry inside it.
    long, shared, planted = 12 + 16 - 1, {}, 0
    entries = {}
    for d, text in docs:
        hashes, places = got[d].hashes.split(","), list(itertools.accumulate(map(int, got[d].positions.split(","))))
        assert hashlib.sha256(got[d].hashes.encode()).hexdigest() == got[d].fingerprint
        assert len(hashes) == len(places) and places == sorted(set(places))
        entries[d] = dict(zip(places, hashes))
        for i in range(0, len(text) - long + 1):
            shared.setdefault(text[i : i + long], []).append((d, i))
    for run, where in shared.items():
        if len(where) > 1:
            planted += 1
            found = [frozenset((p - i, entries[d][p]) for p in range(i, i + 16) if p in entries[d]) for d, i in where[:20]]
            assert frozenset.intersection(*found)
    assert planted > 1000
    mean = lambda c: sum(getattr(r, c) for r in got.values()) / len(got)
    assert mean("near_edited") > 0.45 and mean("near_next") < 0.1


def brute_components(docs, k, percent):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    sets = {}
    for d, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(upper, lower)))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_ngram_join(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_jaccard_join"](spark, SF).collect()}
    assert got == brute_components(docs, 3, 90)


@pytest.mark.parametrize("name,label,least", [("op5_toxicity", "toxic", 0.9), ("op6_quality_field", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = [(r.score, r.predicted, r[label]) for r in rows.filter("held_out").collect()]
    good = [s for s, _, y in rows if y == 1]
    bad = [s for s, _, y in rows if y == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95 and sum(p == y for _, p, y in rows) / len(rows) > least
    assert all(0 <= s <= 1 for s, _, _ in rows)


def test_pipeline(spark, docs):
    import corpus_pipeline

    source = spark.read.parquet(f"{SF}/documents.parquet")
    numbers = [5, 2, 8, 8, 1]
    assert len(corpus_pipeline.STAGES) == len(numbers)
    now = source
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == source.columns
        rows = out.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in now.collect()}
        now = spark.createDataFrame(rows, source.schema)
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in final} <= {r.doc_id for r in now.collect()}
    assert [r.position for r in final] == sorted(r.position for r in final)


def test_pipeline_near_duplicates(spark, docs):
    import corpus_pipeline

    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, source, SF).collect()}
    assert kept == {d for d, (_, root) in brute_components(docs, 5, 80).items() if d == root}
