"""Ranked lexical search over blocked posting lists, exact to the last document.

1. Documents become vectors over the vocabulary of the queries: per term the number
   of occurrences, from which its impact in the document follows. They are written once.
2. Documents are placed by similarity: each is described by the pivot documents it is
   most like, and a range partitioning by that description puts like ones side by side.
3. Per term, the posting list is clustered in that order and cut into blocks of
   ``BLOCK`` documents at most. A block stores its documents and a summary: for each
   term that occurs with the list's term in a query, the largest impact in the block.
4. A query's score in a block is at most the sum of its weights times the summary. A
   block is skipped only if this bound lies below a score that ten documents reach.
   The threshold comes from real documents: first a few placed by hash, then those of
   the blocks with the highest bounds.
5. What is left is scored in full from the vectors, and the ten best stay.

Lists of common terms are long and add little. If all of a query's terms up to some
list together cannot reach the threshold, a document that holds none of its other terms
cannot be among the best, so these lists are not read for that query ("maxscore").
Lists that no query reads get no blocks.

Queries are taken in packs of ``MAX_QUERIES`` that name ``MAX_TERMS`` different terms at
most (a larger query is a pack by itself); what is broadcast are the pack's terms and weights and
``PIVOTS`` vectors. Terms are compared by 64-bit hashes. Scores and bounds are sums of
integers below 2**53, so their order is exact. Copies cost their own rows only: a group
of equal documents is cut into blocks like any other.

Defined results: NULL and empty texts have no terms and match nothing, nor do items
without terms; repeated rows of either table count and answer each for themselves;
a NULL id ranks last among equal scores; without documents or items there are no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import settle
from .words import ALNUM, blocks

MAX_TERMS = 4096
MAX_QUERIES = 1024
BLOCK = 32
PIVOTS = 64
#: Documents that give the first threshold, and blocks per query that give the second.
FIRST_DOCS = 4096
FIRST_BLOCKS = 256
#: Cells of a table of documents by terms that a task holds at once.
CELLS = 1 << 23


# -- queries and vectors -------------------------------------------------------


@dataclass(frozen=True)
class Pack:
    """Some queries: their items' ids, their distinct terms as places in ``hashes``."""

    items: list
    terms: list[np.ndarray]
    hashes: np.ndarray

    def weighted(self, weights: np.ndarray) -> np.ndarray:
        """Terms by queries, float64."""
        table = np.zeros((len(self.hashes), len(self.terms)))
        for q, terms in enumerate(self.terms):
            table[terms, q] = weights[terms]
        return table


def packs(items: DataFrame, item_id: str, text: str, max_terms: int) -> Iterator[Pack]:
    rows = items.select(F.col(item_id).alias("item"), F.col(text).cast("binary").alias("_text"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["_text"].to_pylist(), ALNUM):
                lists = [np.unique(block.hashes[a:b]).view(np.int64) for a, b in zip(block.starts, block.ends)]
                part = batch.slice(block.first, len(block.ends))
                yield pa.RecordBatch.from_arrays([part["item"], pa.array(lists, pa.list_(pa.int64()))], ["item", "terms"])

    schema = StructType([rows.schema["item"], *StructType.fromDDL("terms array<long>").fields])
    named = settle(rows.mapInArrow(distinct, schema).filter(F.size("terms") > 0), "items")
    names, lists, seen = [], [], set()

    def made() -> Pack:
        hashes = np.array(sorted(seen), dtype=np.int64)
        return Pack(names, [np.searchsorted(hashes, np.sort(t)) for t in lists], hashes)

    for row in named.toLocalIterator():
        if names and (len(seen | set(row.terms)) > max_terms or len(names) == MAX_QUERIES):
            yield made()
            names, lists, seen = [], [], set()
        names.append(row["item"])
        lists.append(np.array(row.terms, dtype=np.int64))
        seen |= set(row.terms)
    if names:
        yield made()


def vectors(docs: DataFrame, doc_id: str, text: str, hashes: np.ndarray) -> DataFrame:
    """(row, doc, n, terms, tfs): the number of terms in all, and those of the vocabulary with
    their numbers. ``row`` is unique."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("binary").alias("_text"))
    known = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            for block in blocks(batch["_text"].to_pylist(), ALNUM):
                words = block.hashes.view(np.int64)
                place = np.minimum(np.searchsorted(table, words), len(table) - 1)
                hit = np.flatnonzero(table[place] == words)
                owner = np.searchsorted(block.ends, hit, side="right")
                cells, counts = np.unique(owner * len(table) + place[hit], return_counts=True)
                ends = pa.array(np.searchsorted(cells, np.arange(len(block.ends) + 1) * len(table)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (cells % len(table), counts)]
                part = batch.slice(block.first, len(block.ends))
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(block.counts.astype(np.int64)), *lists], ["doc", "n", "terms", "tfs"])

    schema = StructType([rows.schema["doc"], *StructType.fromDDL("n long, terms array<int>, tfs array<int>").fields])
    return settle(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "vectors")


@dataclass(frozen=True)
class Model:
    """What impacts and weights rest on, over all documents."""

    documents: int
    words: int
    df: np.ndarray
    most: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        n = self.documents
        return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in self.df], dtype=np.float64)


def impacts(tfs: np.ndarray, sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L; ``sizes`` are the n's."""
    if len(sizes) and int(sizes.max()) * 90 * documents >= 1 << 63:
        m = np.array([10 + 90 * int(n) * documents // words for n in sizes], dtype=np.int64)
    else:
        m = 10 + 90 * sizes * documents // max(1, words)
    tf = tfs.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Vectors:
    """The vectors of a batch: flat terms and impacts, and whose they are."""

    def __init__(self, batch: pa.RecordBatch, documents: int, words: int):
        lists = batch["terms"]
        counts = np.diff(lists.offsets.to_numpy())
        self.size = len(counts)
        self.ends = np.cumsum(counts)
        self.owner = np.repeat(np.arange(self.size), counts)
        self.terms = lists.flatten().to_numpy()
        sizes = batch["n"].to_numpy()
        self.impacts = impacts(batch["tfs"].flatten().to_numpy(), sizes[self.owner], documents, words)

    def table(self, begin: int, end: int, width: int) -> np.ndarray:
        """Documents ``begin`` to ``end`` by terms."""
        low = self.ends[begin - 1] if begin else 0
        at = slice(low, self.ends[end - 1] if end else 0)
        out = np.zeros((end - begin, width))
        out[self.owner[at] - begin, self.terms[at]] = self.impacts[at]
        return out


def count(found: DataFrame, pack: Pack) -> Model:
    """Documents with terms, all their terms, and per vocabulary term its documents and largest impact."""
    total = found.filter("n > 0").agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("w")).first()
    width, documents, words = len(pack.hashes), total.d, total.w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, most = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for batch in batches:
            v = Vectors(batch, documents, words)
            df += np.bincount(v.terms, minlength=width)
            np.maximum.at(most, v.terms, v.impacts)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at]), pa.array(most[at])], ["term", "df", "most"])

    parts = found.select("n", "terms", "tfs").mapInArrow(run, "term long, df long, most long")
    df, most = np.zeros(width, dtype=np.int64), np.zeros(width)
    # One row per vocabulary term.
    for r in parts.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most")).toLocalIterator():
        df[r.term], most[r.term] = r.df, r.most
    return Model(documents, words, df, most)


# -- scores --------------------------------------------------------------------


def _tops(scores: np.ndarray, k: int) -> np.ndarray:
    """Per column the k-th largest value, or 1 if there are not so many above 0."""
    if len(scores) < k:
        return np.ones(scores.shape[1])
    return np.maximum(1, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])


def first_threshold(found: DataFrame, pack: Pack, model: Model, k: int) -> np.ndarray:
    """A score that ``k`` documents reach, per query, from ``FIRST_DOCS`` documents at most."""
    weights = found.sparkSession.sparkContext.broadcast(pack.weighted(model.weights))
    documents, words = model.documents, model.words
    some = found.filter(F.size("terms") > 0).orderBy(F.xxhash64("row")).limit(FIRST_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, weights.value.shape[1]))
        for batch in batches:
            v = Vectors(batch, documents, words)
            step = max(1, CELLS // len(weights.value))
            for begin in range(0, v.size, step):
                scores = v.table(begin, min(v.size, begin + step), len(weights.value)) @ weights.value
                best = np.sort(np.concatenate([best, scores]), axis=0)[-k:]
        flat = [pa.array(np.tile(np.arange(best.shape[1]), len(best))), pa.array(best.ravel())]
        yield pa.RecordBatch.from_arrays(flat, ["q", "score"])

    scored = some.select("n", "terms", "tfs").mapInArrow(run, "q long, score double")
    return _kth(scored, len(pack.terms), k)


def _kth(scored: DataFrame, queries: int, k: int) -> np.ndarray:
    """Per query the k-th largest score, at least 1. ``k`` numbers a query reach the driver."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    out = np.ones(queries)
    for r in scored.withColumn("r", rank).filter(F.col("r") <= k).filter(F.col("r") == k).toLocalIterator():
        out[r.q] = max(1.0, r.score)
    return out


def read_lists(pack: Pack, model: Model, least: np.ndarray) -> list[np.ndarray]:
    """The terms of each query whose lists must be read: the others cannot reach ``least`` together."""
    out, weights = [], model.weights
    for terms, low in zip(pack.terms, least):
        terms = terms[model.most[terms] > 0]
        most = weights[terms] * model.most[terms]
        order = np.argsort(most, kind="stable")
        out.append(terms[order][np.cumsum(most[order]) >= low])
    return out


# -- blocks --------------------------------------------------------------------


def coordinates(pack: Pack, reads: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Per list that is read, the terms of the queries that read it: what its summaries hold."""
    out: dict[int, set] = {}
    for terms, lists in zip(pack.terms, reads):
        for t in lists.tolist():
            out.setdefault(t, set()).update(terms.tolist())
    return {t: np.array(sorted(c)) for t, c in sorted(out.items())}


def placed(found: DataFrame, model: Model, width: int) -> DataFrame:
    """The vectors in ranges of likeness: first and second nearest pivot, then equal content."""
    spark, documents, words = found.sparkSession, model.documents, model.words
    weights = model.weights
    pivots = np.zeros((width, PIVOTS), dtype=np.float32)
    full = found.filter(F.size("terms") >= 8)
    for p, r in enumerate(full.orderBy(F.xxhash64(F.lit(1), "row")).limit(PIVOTS).collect()):
        terms = np.array(r.terms)
        value = impacts(np.array(r.tfs), np.full(len(terms), r.n), documents, words) * weights[terms]
        pivots[terms, p] = value * weights[terms] / np.sqrt((value.astype(float) ** 2).sum() or 1)
    shared = spark.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = Vectors(batch, documents, words)
            near = np.zeros(v.size, dtype=np.int64)
            step = max(1, CELLS // PIVOTS // 64)
            for begin in range(0, v.size, step):
                end = min(v.size, begin + step)
                low, high = (v.ends[begin - 1] if begin else 0), v.ends[end - 1]
                like = np.zeros((end - begin, PIVOTS), dtype=np.float32)
                some = np.flatnonzero(np.diff(v.ends[begin:end], prepend=low))
                if len(some):
                    each = shared.value[v.terms[low:high]] * v.impacts[low:high, None].astype(np.float32)
                    starts = np.append(low, v.ends[begin : end - 1])[some] - low
                    like[some] = np.add.reduceat(each, starts, axis=0)
                order = np.argsort(-like, axis=1, kind="stable")
                near[begin:end] = order[:, 0] * PIVOTS + order[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], [*batch.schema.names, "near"])

    schema = StructType([*(found.schema[c] for c in ("row", "n", "terms", "tfs")), *StructType.fromDDL("near long").fields])
    near = found.filter(F.size("terms") > 0).select("row", "n", "terms", "tfs").mapInArrow(run, schema)
    keys = [F.col("near"), F.xxhash64("terms", "tfs"), F.col("row")]
    return near.repartitionByRange(*keys).sortWithinPartitions(*keys)


def posting_blocks(found: DataFrame, model: Model, summaries: dict[int, np.ndarray], width: int) -> DataFrame:
    """(term, rows, most): blocks of the posting lists, written once.

    ``most[i]`` is the largest impact in the block of the i-th of the list's coordinates.
    """
    documents, words = model.documents, model.words
    shared = found.sparkSession.sparkContext.broadcast(summaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, CELLS // width)
        for batch in batches:
            v = Vectors(batch, documents, words)
            for begin in range(0, v.size, step):
                yield from cut(v, begin, min(v.size, begin + step), batch["row"].to_numpy())

    def cut(v: Vectors, begin: int, end: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = v.table(begin, end, width).astype(np.int32)
        low, high = (v.ends[begin - 1] if begin else 0), v.ends[end - 1]
        order = np.argsort(v.terms[low:high], kind="stable")
        terms, owner = v.terms[low:high][order], v.owner[low:high][order] - begin
        starts = np.flatnonzero(np.diff(terms, prepend=-1))
        which, sizes, members, most = [], [], [], []
        held = 0
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(terms)]):
            t = int(terms[s])
            if t not in shared.value:
                continue
            axis = shared.value[t]
            for a in range(s, e, 1024):
                docs = owner[a : min(e, a + 1024)]
                cuts = np.arange(0, len(docs), BLOCK)
                part = np.maximum.reduceat(table[docs[:, None], axis], cuts, axis=0)
                which += [t] * len(cuts)
                sizes += np.diff(cuts, append=len(docs)).tolist()
                members.append(rows[begin + docs])
                most.append(part)
                held += part.size
            if held > CELLS // 8:
                yield block_rows(which, sizes, members, most)
                which, sizes, members, most, held = [], [], [], [], 0
        if which:
            yield block_rows(which, sizes, members, most)

    def block_rows(which, sizes, members, most) -> pa.RecordBatch:
        widths = np.concatenate([np.full(len(m), m.shape[1]) for m in most])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(which, pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(np.concatenate(members))),
                pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(widths)), pa.int32()), pa.array(np.concatenate([m.ravel() for m in most]))
                ),
            ],
            ["term", "rows", "most"],
        )

    made = placed(found, model, width).select("row", "n", "terms", "tfs").mapInArrow(run, "term int, rows array<long>, most array<int>")
    return settle(made, "blocks")


def bound_weights(
    pack: Pack, weights: np.ndarray, reads: list[np.ndarray], summaries: dict[int, np.ndarray]
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per list that is read its queries, and their weights by the coordinates of its summaries."""
    readers: dict[int, list[int]] = {t: [] for t in summaries}
    for q, lists in enumerate(reads):
        for t in lists.tolist():
            readers[t].append(q)
    out = {}
    for t, axis in summaries.items():
        table = np.zeros((len(axis), len(readers[t])))
        for i, q in enumerate(readers[t]):
            table[np.searchsorted(axis, pack.terms[q]), i] = weights[pack.terms[q]]
        if readers[t]:
            out[t] = (np.array(readers[t]), table)
    return out


def block_bounds(batch: pa.RecordBatch, lists: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(block numbers, their queries, bounds of blocks by queries) for each list in the batch."""
    terms = batch["term"].to_numpy()
    ends = batch["most"].offsets.to_numpy()
    ends = ends - ends[0]
    most = batch["most"].flatten().to_numpy()
    order = np.argsort(terms, kind="stable")
    starts = np.flatnonzero(np.diff(terms[order], prepend=-1))
    for part in np.split(order, starts[1:]):
        if len(part) and int(terms[part[0]]) in lists:
            queries, table = lists[int(terms[part[0]])]
            yield part, queries, most[ends[part][:, None] + np.arange(len(table))] @ table


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ends = batch["rows"].offsets.to_numpy()
    return ends - ends[0], batch["rows"].flatten().to_numpy()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - np.append(0, ends[:-1]), sizes) + np.arange(ends[-1] if len(ends) else 0)


def best_blocks(made: DataFrame, bounds, k: int) -> DataFrame:
    """(row, q): the documents of the ``FIRST_BLOCKS`` blocks with the highest bounds of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, rows = _rows_of(batch)
            q, bound, block = [], [], []
            for part, queries, high in block_bounds(batch, bounds.value):
                take = min(FIRST_BLOCKS, len(part))
                top = np.argpartition(-high, take - 1, axis=0)[:take]
                q.append(np.tile(queries, take))
                bound.append(np.take_along_axis(high, top, axis=0).ravel())
                block.append(part[top].ravel())
            if not q:
                continue
            q, bound, block = (np.concatenate(x) for x in (q, bound, block))
            order = np.lexsort((-bound, q))
            first = np.flatnonzero(np.diff(q[order], prepend=-1))
            place = np.arange(len(q)) - np.repeat(first, np.diff(first, append=len(q)))
            at = order[place < FIRST_BLOCKS]
            sizes = np.diff(ends)[block[at]]
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(rows[_spread(ends[block[at]], sizes)])
            )
            yield pa.RecordBatch.from_arrays([pa.array(q[at]), pa.array(bound[at]), lists], ["q", "bound", "rows"])

    found = made.mapInArrow(run, "q long, bound double, rows array<long>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), F.col("rows")[0]))
    some = found.withColumn("r", rank).filter(F.col("r") <= FIRST_BLOCKS)
    return some.select(F.explode("rows").alias("row"), F.col("q").cast("int").alias("q")).groupBy("row").agg(F.collect_set("q").alias("qs"))


def candidates(made: DataFrame, bounds, least) -> DataFrame:
    """(row, qs): documents in blocks whose bound for a query is not below ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, rows = _rows_of(batch)
            found_q, found_row = [], []
            for part, queries, high in block_bounds(batch, bounds.value):
                b, q = np.nonzero(high >= least.value[queries])
                sizes = np.diff(ends)[part[b]]
                found_row.append(rows[_spread(ends[part[b]], sizes)])
                found_q.append(np.repeat(queries[q], sizes))
            if not found_q or not sum(map(len, found_q)):
                continue
            row, q = np.concatenate(found_row), np.concatenate(found_q)
            order = np.lexsort((q, row))
            row, q = row[order], q[order]
            new = np.append(True, (np.diff(row) != 0) | (np.diff(q) != 0))
            row, q = row[new], q[new]
            starts = np.flatnonzero(np.append(True, np.diff(row) != 0))
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()), pa.array(q.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(row[starts]), lists], ["row", "qs"])

    # A document is in one block of a list, so its lists are as many as its vocabulary terms.
    return made.mapInArrow(run, "row long, qs array<int>").groupBy("row").agg(
        F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs")
    )


def scored(found: DataFrame, wanted: DataFrame, pack: Pack, model: Model, least, k: int) -> DataFrame:
    """(q, doc, score) of the wanted documents and queries, those that may be among the ``k`` best."""
    documents, words = model.documents, model.words
    shared = found.sparkSession.sparkContext.broadcast((pack.terms, model.weights, len(pack.hashes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, width = shared.value
        # Every query's terms in one table; the last column of a document is 0 and pads it.
        longest = max(map(len, terms))
        table = np.full((len(terms), longest), width)
        factor = np.zeros((len(terms), longest))
        for q, t in enumerate(terms):
            table[q, : len(t)], factor[q, : len(t)] = t, weights[t]
        step = max(1, CELLS // (width + 1))
        for batch in batches:
            v = Vectors(batch, documents, words)
            counts = np.diff(batch["qs"].offsets.to_numpy())
            owner = np.repeat(np.arange(v.size), counts)
            qs = batch["qs"].flatten().to_numpy()
            scores = np.zeros(len(qs))
            for begin in range(0, v.size, step):
                end = min(v.size, begin + step)
                dense = v.table(begin, end, width + 1)
                low, high = np.searchsorted(owner, (begin, end))
                for a in range(low, high, max(1, CELLS // longest // 4)):
                    at = slice(a, min(high, a + max(1, CELLS // longest // 4)))
                    scores[at] = (dense[owner[at, None] - begin, table[qs[at]]] * factor[qs[at]]).sum(axis=1)
            keep = scores >= least.value[qs]
            # Below the k-th best of its query in this batch nothing can be among the k best.
            order = np.lexsort((-scores, qs))
            order = order[keep[order]]
            first = np.flatnonzero(np.diff(qs[order], prepend=-1))
            sizes = np.diff(first, append=len(order))
            low = np.repeat(scores[order][first + np.minimum(sizes, k) - 1], sizes) if len(order) else np.zeros(0)
            order = order[scores[order] >= low]
            doc = batch["doc"].take(pa.array(owner[order]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(qs[order].astype(np.int64)), doc, pa.array(scores[order].astype(np.int64))], ["q", "doc", "score"]
            )

    schema = StructType([StructField("q", StructType.fromDDL("q long")[0].dataType), found.schema["doc"], *StructType.fromDDL("score long").fields])
    return found.join(wanted, "row").select("doc", "n", "terms", "tfs", "qs").mapInArrow(run, schema)


def search_pack(docs: DataFrame, pack: Pack, doc_id: str, text: str, k: int) -> DataFrame:
    """(q, rank, doc, score) of the pack's queries by their number."""
    spark = docs.sparkSession
    found = vectors(docs, doc_id, text, pack.hashes)
    model = count(found, pack)
    least = first_threshold(found, pack, model, k)
    reads = read_lists(pack, model, least)
    summaries = coordinates(pack, reads)
    made = posting_blocks(found, model, summaries, len(pack.hashes))
    bounds = spark.sparkContext.broadcast(bound_weights(pack, model.weights, reads, summaries))
    first = scored(found, best_blocks(made, bounds, k), pack, model, spark.sparkContext.broadcast(least), k)
    least = np.maximum(least, _kth(first, len(pack.terms), k))
    # A higher threshold leaves fewer lists to read.
    bounds = spark.sparkContext.broadcast(bound_weights(pack, model.weights, read_lists(pack, model, least), summaries))
    shared = spark.sparkContext.broadcast(least)
    best = scored(found, candidates(made, bounds, shared), pack, model, shared, k)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    names = StructType([StructField("item", items.schema[item_id].dataType), *StructType.fromDDL("q long").fields])
    out = None
    for pack in packs(items, item_id, item_text, max_terms):
        best = search_pack(docs, pack, doc_id, text, k)
        named = spark.createDataFrame([(i, q) for q, i in enumerate(pack.items)], names)
        rows = settle(best.join(named, "q").select("item", "rank", "doc", "score"), "ranked")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = StructType([names["item"], *StructType.fromDDL("rank int").fields, StructField("doc", docs.schema[doc_id].dataType)])
        out = spark.createDataFrame([], schema.add("score", "long"))
    return out
