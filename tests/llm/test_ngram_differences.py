"""The n-gram join over long lists: near copies that link to some others, or to none."""

import random

import pytest

from tidemark.llm import ngram_join

from .test_llm_queries import brute_components


def near_copies(rng, n, words, changes):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(*changes)):
            at, kind = rng.randrange(len(own)), rng.randrange(3)
            own[at : at + (kind != 1)] = [] if kind == 0 else [f"own{rng.randrange(10**6)}"]
        if rng.random() < 0.15:  # a piece of the text only
            own = own[: rng.randrange(len(own) // 2, len(own))]
        out.append(own)
    return out


@pytest.mark.parametrize("small", [1, 16])
@pytest.mark.parametrize("rule", [ngram_join.Rule(3, 90), ngram_join.Rule(5, 80), ngram_join.Rule(2, 60)])
def test_groups_of_near_copies(frame, monkeypatch, small, rule):
    """Changes around the threshold, shared changes, pieces, and texts that only share a passage."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rng = random.Random(rule.percent + small)
    texts = near_copies(rng, 60, 120, (0, 8)) + near_copies(rng, 40, 60, (2, 6))
    passage = [f"p{i}" for i in range(30)]
    texts += [[f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))] + passage for _ in range(30)]
    half = texts[5][:60]
    texts += [half + [f"y{rng.randrange(3)}" for _ in range(60)] for _ in range(20)]
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i][1], "a") for i in range(0, 60, 7)]
    rng.shuffle(rows)
    df = frame(rows).repartition(6)
    joined = ngram_join.similarity_join(df, rule)
    got = {r["_doc"]: (r.n, r.component_id) for r in ngram_join.first_of_component(joined).collect()}
    assert got == brute_components([r[:2] for r in rows], rule.k, rule.percent)


def test_unlinked_copies_do_not_meet(frame, monkeypatch):
    """400 near copies of one text, none of which link: few pairs are compared, and none links."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(200), 9):
            own[at] = f"own{rng.randrange(10**9)}"
        rows.append((i, " ".join(own), "a"))
    rows.append((400, " ".join(base), "a"))
    compared = []
    settle = ngram_join.settle

    def counting(df, name="settled"):
        out = settle(df, name)
        if name in ("pairs", "index"):
            compared.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "settle", counting)
    joined = ngram_join.similarity_join(frame(rows), ngram_join.Rule(3, 90))
    assert joined.links.count() == 0
    # A star over each list costs a few pairs a class; all pairs would be 80,000.
    assert sum(n for name, n in compared if name == "pairs") < 8_000
    assert joined.members.select("component").distinct().count() == 401


def test_unlike_texts_of_a_long_list(frame, monkeypatch):
    """Texts that share a passage and nothing else: a part of each is looked at, and nothing of one without a partner."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    texts = [[f"x{rng.randrange(10**9)}" for _ in range(12)] + passage for _ in range(40)]
    texts += [[f"y{rng.randrange(10**9)}" for _ in range(3)] + passage + [f"z{n}w{i}" for i in range(30 * n * n)] for n in (5, 8, 12)]
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    looked = []
    index = ngram_join._Join.difference_index

    def counting(join, parts):
        looked.extend(parts.select("n", "d", "strong").collect())
        return index(join, parts)

    monkeypatch.setattr(ngram_join._Join, "difference_index", counting)
    # All grams of a text are in its prefix, so that the passage makes lists of all texts.
    monkeypatch.setattr(ngram_join, "choose_prefix", lambda seen, n, rule, floor: (1, n))
    joined = ngram_join.similarity_join(frame(rows), ngram_join.Rule(3, 90))
    got = {r["_doc"]: (r.n, r.component_id) for r in ngram_join.first_of_component(joined).collect()}
    assert got == brute_components([r[:2] for r in rows], 3, 90)
    assert looked and all(r.n < 100 for r in looked)
    assert all(r.d <= 1.5 * 0.1 * r.n + 1 for r in looked if r.strong)


def test_grams_of_the_same_texts_are_joined_as_one(frame, monkeypatch):
    """Texts of shared sentences: one row for a sentence and text, not one for each of its grams."""
    rng = random.Random(10)
    sentences = [[f"s{k}w{i}" for i in range(24)] for k in range(14)]
    texts = [sum(rng.sample(sentences, 7), []) for _ in range(150)]
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    counts = []
    settle = ngram_join.settle

    def counting(df, name="settled"):
        out = settle(df, name)
        if name == "index":
            counts.append((out.count(), out.select("ref", "class").distinct().count()))
        return out

    monkeypatch.setattr(ngram_join, "settle", counting)
    monkeypatch.setattr(ngram_join, "choose_prefix", lambda seen, n, rule, floor: (1, n))
    joined = ngram_join.similarity_join(frame(rows), ngram_join.Rule(3, 90))
    got = {r["_doc"]: (r.n, r.component_id) for r in ngram_join.first_of_component(joined).collect()}
    assert got == brute_components([r[:2] for r in rows], 3, 90)
    [(rows_, sets)] = counts
    assert sets and rows_ < 8 * sets


def test_each_text_of_long_lists_is_listed_once(frame, monkeypatch):
    """Texts in many long lists, each with other texts: of each no more is looked at than a part of its grams, once."""
    rng = random.Random(11)
    passages = [[f"p{k}w{i}" for i in range(8)] for k in range(12)]
    texts = []
    for i in range(160):
        own = [f"x{rng.randrange(10**9)}" for _ in range(20)]
        texts.append(sum(rng.sample(passages, 4), []) + own)
        if i % 20 == 0:  # one that links to it
            texts.append(texts[-1] + [f"y{i}"])
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    looked = []
    index = ngram_join._Join.difference_index

    def counting(join, parts):
        looked.extend(parts.selectExpr("class", "n", "size(grams) as looked").collect())
        return index(join, parts)

    monkeypatch.setattr(ngram_join._Join, "difference_index", counting)
    monkeypatch.setattr(ngram_join, "choose_prefix", lambda seen, n, rule, floor: (1, n))
    joined = ngram_join.similarity_join(frame(rows), ngram_join.Rule(3, 90))
    got = {r["_doc"]: (r.n, r.component_id) for r in ngram_join.first_of_component(joined).collect()}
    assert got == brute_components([r[:2] for r in rows], 3, 90)
    assert looked and len(looked) == len({r["class"] for r in looked})
    assert all(r.looked <= 1.5 * 0.1 * r.n + 1 for r in looked)


def test_shared_text_of_near_copies_is_not_joined(frame, monkeypatch):
    """Near copies around the threshold, of which prefixes show only a part of what they share: no list of shared grams is paired."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        own = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 6)):
            own[at] = f"own{rng.randrange(10**9)}"
        rows.append((i, " ".join(own), "a"))
    joins = []
    settle = ngram_join.settle

    def counting(df, name="settled"):
        out = settle(df, name)
        if name == "index":
            joins.extend(out.select("by", "size").distinct().collect())
        return out

    monkeypatch.setattr(ngram_join, "settle", counting)
    joined = ngram_join.similarity_join(frame(rows).repartition(4), ngram_join.Rule(3, 90))
    got = {r["_doc"]: (r.n, r.component_id) for r in ngram_join.first_of_component(joined).collect()}
    assert got == brute_components([r[:2] for r in rows], 3, 90)
    assert joins
    assert all(r.size <= ngram_join.SMALL for r in joins if r.by == "free")
