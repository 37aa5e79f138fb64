"""Exact dedup: decisions against a plain version, batches, re-runs."""

import re

import pytest

from tidemark.llm import exact_dedup
from tidemark.session import new_folder


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    return sorted(((i, least(groups[normal(t)]), len(groups[normal(t)])) for i, t in rows), key=str)


@pytest.fixture
def make(spark):
    def index(buckets=8):
        return exact_dedup.DigestIndex.create(spark, new_folder(spark, "digests"), "bigint", buckets)

    return index


def decided(rows, index):
    return exact_dedup.decisions(rows, index).collect()


@pytest.mark.parametrize("cuts", [[], [5], [3, 9]])
@pytest.mark.parametrize("buckets", [8, 5])
def test_odd_tables(spark, odd, make, cuts, buckets):
    index = make(buckets)
    rows = exact_dedup.digests(odd)
    exact_dedup.admit_in_order(rows, index, cuts)
    got = decided(rows, index)
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == want
    assert sum(r.kept for r in got) == index.entries().count() == len({normal(r.text) for r in odd.collect()})
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_empty(spark, empty, make):
    index = make()
    rows = exact_dedup.digests(empty)
    exact_dedup.admit_in_order(rows, index, [])
    assert decided(rows, index) == [] and index.entries().count() == 0
    assert exact_dedup.keep_first(empty, index, 2).columns == empty.columns


def test_blanks_are_one_space(spark):
    texts = ["a b", "a  b", "a\tb", "a\x0b\x0c\r\nb", "a \n b", " a b", "a b ", "a b", "a\x1cb", " ", "\n", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(exact_dedup.normal_text(df.t)).collect()]
    assert got == [normal(t) for t in texts]


def test_large_groups(spark, make):
    """A third of all rows in one group, another third in pairs."""
    rows = [(i, "hot") for i in range(3000)] + [(3000 + i, f"pair {i // 2}") for i in range(3000)]
    rows += [(6000 + i, f"own {i}") for i in range(3000)]
    index = make()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = exact_dedup.digests(docs)
    exact_dedup.admit_in_order(found, index, [4501])
    got = decided(found, index)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == plain(rows)
    assert sum(r.kept for r in got) == 1 + 1500 + 3000


def test_later_batches_and_reruns(spark, frame, make):
    first = frame([(5, "one", "a"), (6, "two", "a"), (7, "two  three", "a")])
    second = frame([(1, "one", "a"), (2, "four", "b"), (8, "four", "b"), (2, "four", "b"), (9, "two\nthree", "b")])
    index = make()
    assert sorted(r.doc_id for r in exact_dedup.keep_first(first, index, 1).collect()) == [5, 6, 7]
    again = exact_dedup.DigestIndex.open(spark, index.path)
    assert again == index
    for _ in range(2):  # a batch that is repeated sees only the batches before it
        kept = exact_dedup.keep_first(second, again, 2)
        assert kept.columns == second.columns
        assert [(r.doc_id, r.text) for r in kept.collect()] == [(2, "four")]
        assert again.entries().count() == 4
    rows = exact_dedup.digests(second)
    got = {(r.id, r.keep_id, r.group_size, r.kept) for r in decided(rows, again)}
    assert got == {(1, 5, 1, False), (2, 2, 3, True), (2, 2, 3, False), (8, 2, 3, False), (9, 7, 1, False)}


def test_index_is_not_shuffled(spark, frame, make):
    index = make(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = exact_dedup.digests(frame([(1, "x", "a")]))
    index.admit(rows, 1)
    for df in (index.fresh(rows, 2), index.groups(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
