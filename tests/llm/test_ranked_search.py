"""Ranked search against scoring every document, and the parts that make it exact."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ranked_search as rs

ITEMS = "item_id long, text string, q long, rank int, doc string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    held = [(d, terms_of(t)) for d, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, words in held:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for d, words in held:
            score = 0
            m = 10 + 90 * len(words) * n_docs // max(1, n_words)
            for w in set(terms_of(text)):
                tf = words.count(w)
                if tf:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=str)


def found(docs, items, **options):
    rows = rs.search(docs, items, **options).collect()
    return sorted(((r["item"], r["rank"], r.doc, r.score) for r in rows), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], ITEMS)


def texts(rng, n, words):
    vocabulary = [f"w{int(30 * rng.random() ** 3)}" for _ in range(60)] + [f"x{i}é" for i in range(60)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, words))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_document(spark, frame, monkeypatch, seed):
    """Small blocks and thresholds from few documents, so that most is left to the bounds."""
    monkeypatch.setattr(rs, "BLOCK", 3)
    monkeypatch.setattr(rs, "FIRST_DOCS", 30)
    monkeypatch.setattr(rs, "FIRST_BLOCKS", 2)
    rng = random.Random(seed)
    own = texts(rng, 300, 60)
    docs = list(enumerate(own)) + [(1000 + i, own[7]) for i in range(120)] + [(2000 + i, "w1 w2") for i in range(40)]
    rng.shuffle(docs)
    items = list(enumerate(texts(rng, 12, 25))) + [(50, own[7]), (51, "w1"), (52, "nowhere"), (53, own[9] + " " + own[10])]
    df = frame([(d, t, "a") for d, t in docs]).repartition(5)
    assert found(df, items_of(spark, items)) == plain(docs, items)


def test_odd_tables(spark, odd, empty):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, None), (2, ""), (3, "?!"), (4, "the SAME row"), (4, "the SAME row"), (None, "lorem one text"), (7, "é" * 40 + " ß W")]
    assert found(odd, items_of(spark, items)) == plain(docs, items)
    assert found(empty, items_of(spark, items)) == []
    assert found(odd, items_of(spark, [])) == []
    assert rs.search(odd, items_of(spark, [])).columns == rs.search(odd, items_of(spark, items)).columns


@pytest.mark.parametrize("limits", [(3, 1024), (4096, 2)])
def test_packs(spark, frame, monkeypatch, limits):
    """Queries in many packs give what they give together, a large one on its own."""
    monkeypatch.setattr(rs, "MAX_QUERIES", limits[1])
    rng = random.Random(9)
    docs = list(enumerate(texts(rng, 60, 20)))
    items = list(enumerate(texts(rng, 4, 9)))
    df = frame([(d, t, "a") for d, t in docs])
    assert found(df, items_of(spark, items), max_terms=limits[0]) == plain(docs, items)


def test_bounds_hold_and_skip(spark, frame):
    """No block's bound is below a score in it; with a real threshold most pairs are skipped."""
    rng = random.Random(4)
    docs = list(enumerate(texts(rng, 400, 40)))
    items = [(i, docs[i][1]) for i in range(0, 40, 10)]
    df = frame([(d, t, "a") for d, t in docs])
    (pack,) = rs.packs(items_of(spark, items), "item_id", "text", 4096)
    vectors = rs.vectors(df, "doc_id", "text", pack.hashes)
    model = rs.count(vectors, pack)
    low = np.ones(len(items))
    reads = rs.read_lists(pack, model, low)
    summaries = rs.coordinates(pack, reads)
    made = rs.posting_blocks(vectors, model, summaries, len(pack.hashes))
    assert made.agg(F.sum(F.size("rows"))).first()[0] == int(model.df[list(summaries)].sum())
    everything = {}
    for r in vectors.collect():
        table = np.zeros(len(pack.hashes))
        table[r.terms] = rs.impacts(np.array(r.tfs), np.full(len(r.terms), r.n), model.documents, model.words)
        everything[r.row] = table
    weights = pack.weighted(model.weights)
    for r in made.collect():
        axis = summaries[r.term]
        tables = np.array([everything[row] for row in r.rows])
        assert len(r.rows) <= rs.BLOCK and (tables[:, r.term] > 0).all()
        assert (tables[:, axis].max(axis=0) == np.array(r.most)).all()
    scores = {row: table @ weights for row, table in everything.items()}
    tenth = np.sort(np.array(list(scores.values())), axis=0)[-10]
    shared = spark.sparkContext.broadcast
    bounds = shared(rs.bound_weights(pack, model.weights, rs.read_lists(pack, model, tenth), summaries))
    left = {(r.row, q) for r in rs.candidates(made, bounds, shared(tenth)).collect() for q in r.qs}
    assert {(row, q) for row, s in scores.items() for q in range(len(items)) if s[q] >= tenth[q]} <= left
    assert len(left) < len(scores) * len(items) / 2


def test_thresholds_are_reached(spark, frame):
    rng = random.Random(6)
    docs = list(enumerate(texts(rng, 200, 30)))
    (pack,) = rs.packs(items_of(spark, [(1, docs[3][1]), (2, "x1é"), (3, "nowhere")]), "item_id", "text", 4096)
    vectors = rs.vectors(frame([(d, t, "a") for d, t in docs]), "doc_id", "text", pack.hashes)
    model = rs.count(vectors, pack)
    least = rs.first_threshold(vectors, pack, model, 10)
    want = plain(docs, [(1, docs[3][1]), (2, "x1é")], 10)
    for q, item in enumerate(pack.items):
        tenth = [s for i, r, _, s in want if i == item and r == 10]
        assert least[q] <= (tenth[0] if tenth else 1)


def test_large_sizes_do_not_overflow():
    tfs, sizes = np.array([3, 1]), np.array([10**9, 5])
    got = rs.impacts(tfs, sizes, 10**12, 10**15)
    assert got.tolist() == [10**9 * t // (1000 * t + 8 * (10 + 90 * n * 10**12 // 10**15)) for t, n in ((3, 10**9), (1, 5))]
