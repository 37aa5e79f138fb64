"""Similarity join of documents on word n-grams, with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word n-grams
reaches a threshold. All sets are ordered rare grams first. If two sets are
similar enough, their prefixes of length ``size - required overlap + m`` share at
least ``m`` grams, for any m. A longer prefix costs more postings but asks for more
matches, so each document takes the ``m`` whose estimated cost (postings read plus
candidates left to verify) is least, and a pair is verified when it shares at
least the smaller ``m`` of the two.

What keeps groups of copies cheap, without leaving out a link between components:

* equal sets become one class before anything else;
* a gram's list is first verified as a star around its most central class (the
  one in whose order the gram comes earliest), and the links are closed to
  components; a list whose classes are all connected is done;
* of the other lists, those of up to ``SMALL`` classes give their pairs across
  components whose prefixes share enough, and these are verified;
* of the classes of longer lists all grams are counted, and those that more than ``SMALL`` of
  them hold are put behind all others in the order. A class with more other grams than it can
  hold without a class it links to (a free one) shares some of these with each of them: pairs
  with a free class are joined on these, in lists of ``SMALL`` classes at most, and each class
  is listed once, however many long lists it is in;
* the other classes of a longer list are compared by how they differ from one of the list, the
  reference H (the one most central in most lists). With A = H - X + Y, the sets of differences D = X + Y of two classes
  that link share all but ``|A - B| + |B - A|`` of their grams, and more than a fixed
  part unless both link to H and are connected already. So prefixes of the sets of
  differences are joined, rare ones first: near copies that share a text but none of
  their changes never meet. A class with more in Y than it can hold without a class
  it links to shares a part of Y with each of them, so for pairs with such a class
  only prefixes of Y are joined: what H alone holds is left out. Of a long Y, no more is
  looked at than the part that comes first in the order of all grams and shares
  ``1 + alone`` grams with any it links to, ``alone`` being what it can hold without
  that one. Grams that the same classes hold are joined as one.

So every pair of classes that could link is either verified or already connected;
pairs inside a component are never listed.

Gram frequencies come from counts of all grams that repeat among neighbouring
documents, in slots of fixed number; any order common to all documents gives the
same links. Texts are read three times and never
shuffled. Grams are 64-bit hashes, classes 128-bit ones.

Defined results: words are runs of non-blank characters with A-Z lower-cased; a
text with fewer words than ``k`` is one gram; NULL, empty and blank texts have no
gram, link with nothing and are components of their own; rows with equal ids
and texts count once for links and keep their rows; an empty table gives empty
results.
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

from ..session import outlast, scratch, settle
from .components import components
from .dense import count_rows, summed
from .words import NON_BLANK, blocks, few_rows, marked, mixed, slot_bits

COUNT_SLOTS = 1 << 20
#: Grams that are looked through for repeats at once.
COUNT_BLOCK = 1 << 22
MOST_MATCHES = 4
#: Lists of up to so many classes are joined with themselves.
SMALL = 16
#: Verifying one candidate costs about as much as reading so many postings.
VERIFY_COST = 8.0
CLASS = ["s1", "s2", "n"]
#: Lists that agree in these have the same classes.
ALIKE = ["h1", "h2", "size"]
_ID_BITS = 51
_MAX_PLACE = (1 << (63 - _ID_BITS)) - 1


@dataclass(frozen=True)
class Rule:
    """``k`` words to a gram; a link needs ``percent`` % of the union in common."""

    k: int = 5
    percent: int = 80

    def overlap(self, n: int) -> int:
        """Grams that a set of ``n`` shares with any set it links to."""
        return -(-self.percent * n // 100)

    def most_apart(self, n):
        """Grams (a column) that a set of ``n`` and one it links to hold without each other, at most."""
        return F.floor((100 - self.percent) * (n + F.floor(100 * n / self.percent)) / (100 + self.percent))


def gram_sets(texts: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct gram hashes of each text."""
    salts = mixed(np.arange(1000, 1000 + k, dtype=np.uint64)) | np.uint64(1)
    for block in blocks(texts, NON_BLANK):
        h = block.hashes
        n = max(0, len(h) - k + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            grams += salts[i] * h[i : i + n]
        grams = mixed(grams)
        for start, end in zip(block.starts, block.ends):
            if end - start >= k:
                yield np.unique(grams[start : end - k + 1])
            elif end > start:
                short = np.array([end - start], dtype=np.uint64)
                for i in range(start, end):
                    short += salts[i - start] * h[i : i + 1]
                yield mixed(mixed(short))
            else:
                yield np.zeros(0, dtype=np.uint64)


def _class_hash(grams: np.ndarray) -> tuple[int, int]:
    a = mixed(grams ^ np.uint64(0x5BD1E995))
    b = mixed(grams ^ np.uint64(0xC2B2AE3D27D4EB4F))
    with np.errstate(over="ignore"):
        return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(20)) & np.uint64(COUNT_SLOTS - 1)


def _count_repeats(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    """Add the grams that several of these sets hold. Grams of one set only, which are
    nearly all, would fill every slot and hide the frequent ones."""
    if sets:
        grams, n = np.unique(np.concatenate(sets), return_counts=True)
        often = n > 1
        counts += np.bincount(_slot(grams[often]).astype(np.int64), weights=n[often], minlength=len(counts)).astype(np.int64)
        sets.clear()


def _survey(k: int):
    """One row per text with its class, and at the end of a task its counts of repeated grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_SLOTS, dtype=np.int64)
        kind, waiting = None, []
        for batch in few_rows(batches):
            kind = batch["_doc"].type
            sizes, s1, s2 = [], [], []
            for grams in gram_sets(batch["_text"].to_pylist(), k):
                waiting.append(grams)
                if sum(map(len, waiting[-1000:])) > COUNT_BLOCK or len(waiting) > 10_000:
                    _count_repeats(counts, waiting)
                a, b = _class_hash(grams)
                sizes.append(len(grams))
                s1.append(a)
                s2.append(b)
            none = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["_doc"], batch["_row"], pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sizes, pa.int64()), none,
                 pa.nulls(len(sizes), pa.list_(pa.int64()))],
                ["_doc", "_row", *CLASS, "chunk", "counts"],
            )
        _count_repeats(counts, waiting)
        if kind is not None:
            sums = count_rows(counts)
            n = len(sums[0])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), *(pa.nulls(n, pa.int64()) for _ in ("_row", *CLASS)), *sums],
                ["_doc", "_row", *CLASS, "chunk", "counts"],
            )

    return run


def gram_counts(survey: DataFrame) -> np.ndarray:
    """Counts of repeated grams by slot; 8 MB come to the driver, whatever the input."""
    return summed(survey.filter("chunk is not null").select("chunk", "counts"), COUNT_SLOTS)


def choose_prefix(order_counts: np.ndarray, n: int, rule: Rule, floor: float) -> tuple[int, int]:
    """(matches asked for, prefix length) of least estimated cost.

    ``order_counts``: slot counts of the grams in order; ``floor``: what an
    ordinary slot holds, which says nothing about a gram.
    """
    base = n - rule.overlap(n)
    lists = np.cumsum(np.maximum(order_counts[: base + MOST_MATCHES] - floor, 0.0) + 1.0)
    best = (np.inf, 1, base + 1)
    for m in range(1, min(MOST_MATCHES, n - base) + 1):
        read = lists[base + m - 1]
        best = min(best, (read + VERIFY_COST * read / m, m, base + m))
    return best[1], best[2]


def _ordinary(known: np.ndarray) -> float:
    """What an ordinary slot holds."""
    return float(np.median(known)) * 1.25


def _rare_first(grams: np.ndarray, seen: np.ndarray, floor: float) -> np.ndarray:
    """The order common to all sets."""
    return np.lexsort((grams, np.where(seen <= floor, 0, seen)))


def _prefixes(rule: Rule, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        floor = _ordinary(known)
        for batch in few_rows(batches):
            rows: dict[str, list] = {c: [] for c in ("_at", *CLASS, "m", "prefix")}
            for i, grams in enumerate(gram_sets(batch["_text"].to_pylist(), rule.k)):
                if not len(grams):
                    continue
                seen = known[_slot(grams)]
                order = _rare_first(grams, seen, floor)
                m, length = choose_prefix(seen[order], len(grams), rule, floor)
                a, b = _class_hash(grams)
                for name, value in zip(rows, (i, a, b, len(grams), m, grams[order[:length]].view(np.int64))):
                    rows[name].append(value)
            docs = batch["_doc"].take(pa.array(rows["_at"], pa.int64()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [docs, *(pa.array(rows[c], t) for c, t in zip((*CLASS, "m", "prefix"), types))],
                ["_doc", *CLASS, "m", "prefix"],
            )

    return run


def _sets(k: int, bits, counts):
    """The gram sets, rare grams first, of the texts whose class may be marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        floor = _ordinary(known)
        for batch in few_rows(batches):
            s1, s2, sizes, sets = [], [], [], []
            for grams in gram_sets(batch["_text"].to_pylist(), k):
                if not len(grams):
                    continue
                a, b = _class_hash(grams)
                if marked(np.array([a]).view(np.uint64), bits.value)[0]:
                    s1.append(a)
                    s2.append(b)
                    sizes.append(len(grams))
                    sets.append(grams[_rare_first(grams, known[_slot(grams)], floor)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (s1, s2, sizes)), pa.array(sets, pa.list_(pa.int64()))],
                [*CLASS, "grams"],
            )

    return run


def _set_back(late):
    """The sets with the grams that ``late`` may mark at the end; ``free`` others are before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            sets, free = [], []
            for grams in batch["grams"]:
                grams = grams.values.to_numpy(zero_copy_only=False)
                last = marked(grams.view(np.uint64), late.value)
                sets.append(np.concatenate([grams[~last], grams[last]]))
                free.append(len(grams) - int(last.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["class"], batch["n"], pa.array(free, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["class", "n", "free", "grams"],
            )

    return run


@dataclass(frozen=True)
class Joined:
    """``members``: (_doc, n, class, component) of every row, where class and
    component are NULL without grams and a component is its least class.
    ``classes``: (class, n, first_doc). ``links``: (u, v, common) between classes."""

    members: DataFrame
    classes: DataFrame
    links: DataFrame


class _Join:
    def __init__(self, docs: DataFrame, doc_id: str, text: str, rule: Rule) -> None:
        self.rule = rule
        self.spark = docs.sparkSession
        self.tokens = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("binary").alias("_text"))
        # The hash of the text tells rows of one id apart.
        self.marked = self.tokens.withColumn("_row", F.xxhash64("_text"))

    def survey(self) -> DataFrame:
        schema = StructType([self.tokens.schema["_doc"], *_fields("_row long, s1 long, s2 long, n long, chunk int, counts array<long>")])
        return settle(self.marked.mapInArrow(_survey(self.rule.k), schema), "survey")

    def classes(self, survey: DataFrame) -> DataFrame:
        """(class, s1, s2, n, m, prefix, first_doc), one row per distinct set."""
        self.counts = self.spark.sparkContext.broadcast(gram_counts(survey))
        schema = StructType([self.tokens.schema["_doc"], *_fields("s1 long, s2 long, n long, m int, prefix array<long>")])
        found = self.tokens.mapInArrow(_prefixes(self.rule, self.counts), schema)
        # Equal sets have equal prefixes, so any of them will do.
        reduced = found.groupBy(*CLASS).agg(
            F.min("_doc").alias("first_doc"), F.first("m").alias("m"), F.first("prefix").alias("prefix")
        )
        # The ids are fixed by being written before anything uses them.
        found = settle(reduced.withColumn("class", F.monotonically_increasing_id()), "classes")
        if (found.agg(F.max("class")).first()[0] or 0) >> _ID_BITS:
            raise ValueError(f"class numbers need more than {_ID_BITS} bits: use fewer shuffle partitions")
        return found

    def lists(self, classes: DataFrame) -> DataFrame:
        """(gram, class, place, n, m, hub): the postings of grams with two classes or more.

        ``hub`` is the class in whose order the gram comes first. Place and class
        share one number, so that the least of them is found in hash aggregation.
        """
        each = classes.select("class", F.posexplode("prefix").alias("place", "gram"))
        key = F.expr(f"shiftleft(cast(least(place, {_MAX_PLACE}) as long), {_ID_BITS})") + F.col("class")
        postings = each.select("gram", key.alias("key"))
        ends = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("hub"))
        id_of = lambda c: F.col(c).bitwiseAND((1 << _ID_BITS) - 1)
        shared = postings.join(ends.filter("size > 1"), "gram").select(
            "gram",
            id_of("key").alias("class"),
            F.shiftright("key", _ID_BITS).cast("int").alias("place"),
            id_of("hub").alias("hub"),
        )
        return settle(shared.join(classes.select("class", "n", "m"), "class"), "lists")

    def sets_of(self, nodes: DataFrame, classes: DataFrame) -> DataFrame:
        """(class, n, grams) of the classes in ``nodes``, written once."""
        needed = settle(nodes.join(classes.select("class", *CLASS), "class"), "needed")
        bits = self.spark.sparkContext.broadcast(slot_bits(needed, "s1"))
        schema = "s1 long, s2 long, n long, grams array<long>"
        found = self.tokens.mapInArrow(_sets(self.rule.k, bits, self.counts), schema)
        found = found.groupBy(*CLASS).agg(F.first("grams").alias("grams"))
        return settle(found.join(needed, CLASS).select("class", "n", "grams"), "sets")

    def verify(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (u, v) that link, with the size of their intersection."""
        with scratch(self.spark):
            pairs = settle(pairs, "pairs")
            nodes = pairs.select(F.col("u").alias("class")).unionByName(pairs.select(F.col("v").alias("class"))).distinct()
            sets = self.sets_of(nodes, classes)
            found = settle(self.linked(pairs, sets), "links")
            outlast()
            return found

    def linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("class").alias("u"), F.col("n").alias("n_u"), F.col("grams").alias("g_u"))
        right = sets.select(F.col("class").alias("v"), F.col("n").alias("n_v"), F.col("grams").alias("g_v"))
        met = pairs.select("u", "v").join(left, "u").join(right, "v")
        common = met.withColumn("common", F.size(F.array_intersect("g_u", "g_v")).cast("long"))
        return common.filter(self.links(F.col("common"), F.col("n_u"), F.col("n_v"))).select("u", "v", "common")

    def links(self, common, n_u, n_v):
        return common * 100 >= (n_u + n_v - common) * self.rule.percent

    def similar_size(self, a: str, b: str):
        low, high = F.least(a, b), F.greatest(a, b)
        return low * 100 >= high * self.rule.percent

    def star_pairs(self, lists: DataFrame, classes: DataFrame) -> DataFrame:
        hubs = classes.select(F.col("class").alias("hub"), F.col("n").alias("n_hub"), F.col("m").alias("m_hub"))
        near = lists.filter("class <> hub").groupBy("class", "hub", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
        near = near.join(hubs, "hub").filter(self.similar_size("n", "n_hub") & (F.col("shared") >= F.least("m", "m_hub")))
        return near.select(F.least("class", "hub").alias("u"), F.greatest("class", "hub").alias("v")).distinct()

    def open_lists(self, lists: DataFrame, parts: DataFrame) -> DataFrame:
        """The lists with classes of several components, one row for each class of a list.

        Lists of exactly the same classes give the same pairs, so they become one
        list that counts as many grams.
        """
        placed = lists.select("gram", "class", "place", "n", "m", "hub").join(
            parts.select(F.col("node").alias("class"), "root"), "class", "left"
        ).withColumn("root", F.coalesce("root", "class"))
        open_ = placed.groupBy("gram").agg(
            F.min("root").alias("a"),
            F.max("root").alias("b"),
            F.bit_xor(F.xxhash64("class")).alias("h1"),
            F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("h2"),
            F.count(F.lit(1)).alias("size"),
        )
        open_ = settle(open_.filter("a <> b").select("gram", *ALIKE), "open-grams")
        rows = placed.join(open_, "gram").groupBy(*ALIKE, "class", "root", "n", "m").agg(
            F.count(F.lit(1)).alias("grams"), F.min("place").alias("first"), F.max("place").alias("last"), F.min("hub").alias("hub")
        )
        return settle(rows, "open")

    def cross_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components that may link by what their prefixes share.

        A pair is kept if its prefixes share enough grams and enough can follow: behind
        the last shared gram no more than the shorter rest can be common. Pairs that
        are in a longer list as well are found there.
        """
        rows = rows.filter(F.col("size") <= SMALL).drop("hub")
        other = rows.select(*(F.col(c).alias(c if c in ALIKE else f"{c}_v") for c in rows.columns))
        n, n_v = F.col("n"), F.col("n_v")

        def enough(common):
            return common * (100 + self.rule.percent) >= (n + n_v) * self.rule.percent

        # Places that were cut off are too small, which only raises these bounds.
        most = F.least("first", "first_v") + F.least(n - F.col("first"), n_v - F.col("first_v"))
        pairs = rows.join(other, ALIKE).filter(
            (F.col("class") < F.col("class_v"))
            & (F.col("root") != F.col("root_v"))
            & self.similar_size("n", "n_v")
            & enough(most)
        )
        counted = pairs.groupBy(F.col("class").alias("u"), F.col("class_v").alias("v"), "n", "n_v", F.least("m", "m_v").alias("m")).agg(
            F.sum("grams").alias("shared"), F.max("last").alias("last"), F.max("last_v").alias("last_v")
        )
        rest = F.least(n - F.col("last"), n_v - F.col("last_v")) - 1
        return counted.filter((F.col("shared") >= F.col("m")) & enough(F.col("shared") + rest)).select("u", "v")

    def alone(self, n):
        """Grams (a column) that a set of ``n`` can hold without one that it links to."""
        return n - F.ceil(self.rule.percent * n / 100)

    def long_lists(self, rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The classes of longer lists, (h1, h2, size, hub, class, root, n, strong), and their sets, (class, root,
        n, free, grams, strong); ``strong`` if the grams that few of them hold are enough for all its links."""
        rows = rows.filter(F.col("size") > SMALL).select(*ALIKE, "hub", "class", "root")
        nodes = settle(rows.select("class", "root").distinct(), "nodes")
        sets = self.sets_of(nodes.select("class"), classes)
        # Prefixes show only the first of the grams that many hold: those behind them are as frequent.
        held = sets.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
        late = self.spark.sparkContext.broadcast(slot_bits(held.filter(F.col("size") > SMALL), "gram"))
        sets = settle(sets.mapInArrow(_set_back(late), "class long, n long, free long, grams array<long>"), "ordered")
        sets = sets.join(nodes, "class").withColumn("strong", F.col("free") > self.alone(F.col("n")))
        return rows.join(sets.select("class", "n", "strong"), "class"), sets

    def with_partner(self, rows: DataFrame, key: list[str]) -> DataFrame:
        """The rows beside one of similar size and another component, one of them strong."""
        # Sizes of a pair are at most one level apart.
        sized = rows.withColumn("level", F.floor(F.log("n") / math.log(101 / self.rule.percent)))
        around = F.explode(F.sequence(F.col("level") - 1, F.col("level") + 1)).alias("level")
        counts = sized.groupBy(*key, "level").agg(
            F.min("root").alias("a"), F.max("root").alias("b"), F.count_if("strong").alias("met")
        )
        counts = counts.select(*key, around, "a", "b", "met").groupBy(*key, "level")
        paired = counts.agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("met").alias("met"))
        return sized.join(paired.filter("a <> b and met > 0"), [*key, "level"], "left_semi").drop("level")

    def first_grams(self, size, n):
        """(d, prefix): of ``size`` grams in a common order that is more than ``alone``, as many as share ``m`` with
        those of any link, where ``m`` goes by the smaller of the two; and the prefix of these, in
        any other common order, that shares one."""
        alone = self.alone(n)
        least = self.alone(F.ceil(self.rule.percent * n / 100))
        d = F.least(size, alone + F.floor(alone / 2) + 1)
        return d, F.greatest(alone + 1, d - F.floor(least / 2))

    def free_parts(self, listed: DataFrame, sets: DataFrame) -> DataFrame:
        """What is joined of the grams that few classes hold, in the columns of ``difference_parts``."""
        d, prefix = self.first_grams(F.col("free"), F.col("n"))
        return sets.join(listed, "class", "left_semi").select(
            F.lit(-1).cast("long").alias("ref"), "class", "root", "n", F.lit(0).cast("long").alias("common"), F.lit("free").alias("by"),
            "strong", prefix.alias("long"), prefix.alias("short"), d.alias("d"), F.slice("grams", F.lit(1), d.cast("int")).alias("grams"),
        )

    def differences(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """(ref, class, root, n, diff, common, near): how the classes of longer lists that are not strong differ
        from their reference; ``near`` if they link to it."""
        rows = self.with_partner(rows.filter("not strong").withColumn("strong", F.lit(True)), ALIKE).drop("n", "strong")
        # One class for as many lists as can be, so that classes of several lists differ from few.
        central = rows.select(*ALIKE, "hub").distinct().groupBy(F.col("hub").alias("class")).agg(F.count(F.lit(1)).alias("lists"))
        # The hub is a class of the list, but may be a strong one.
        hubs = rows.select(*ALIKE, "hub", "class").unionByName(rows.select(*ALIKE, "hub", F.col("hub").alias("class"))).distinct()
        refs = hubs.join(central, "class").groupBy(*ALIKE).agg(F.max(F.struct("lists", "class"))["class"].alias("ref"))
        members = settle(rows.join(refs, ALIKE).select("ref", "class", "root").distinct(), "members")
        sets = sets.select("class", "n", "grams")
        hubs = sets.select(F.col("class").alias("ref"), F.col("n").alias("n_ref"), F.col("grams").alias("g_ref"))
        both = members.join(sets, "class").join(hubs, "ref")
        own = both.withColumn("own", F.array_except("grams", "g_ref")).withColumn("common", F.col("n") - F.size("own"))
        return settle(
            own.select(
                "ref", "class", "root", "n",
                F.concat("own", F.array_except("g_ref", "grams")).alias("diff"),
                "common",
                self.links(F.col("common"), F.col("n"), F.col("n_ref")).alias("near"),
            ),
            "differences",
        )

    def difference_parts(self, found: DataFrame) -> DataFrame:
        """(ref, class, root, n, common, by, strong, long, short, d, grams): what of the differences
        is joined. Sets of ``d`` grams; prefixes of ``long`` and ``short`` of them."""
        size, own = F.size("diff").cast("long"), F.col("n") - F.col("common")
        # Shared by any link: all but what the two hold without each other; and, if the
        # other does not link to the reference, more than percent / (100 + percent) of D.
        apart = F.greatest(F.lit(1), size - self.rule.most_apart(F.col("n")))
        part = F.floor(self.rule.percent * size / (100 + self.rule.percent)) + 1
        alone = self.alone(F.col("n"))
        # A class with more grams of its own than it can hold without the other shares some
        # of these. In the order of all grams, the first alone + m of them and as many of the
        # other share m (or all they share at all), for any m: here half of alone, and 1.
        first, prefix = self.first_grams(own, F.col("n"))
        by_own = F.struct(
            F.lit("own").alias("by"), (own > alone).alias("strong"), prefix.alias("long"), prefix.alias("short"),
            first.alias("d"), F.slice("diff", F.lit(1), first.cast("int")).alias("grams"),
        )
        by_all = F.struct(
            F.lit("all").alias("by"), (~F.col("near")).alias("strong"), (size - apart + 1).alias("long"),
            (size - F.greatest(apart, part) + 1).alias("short"), size.alias("d"), F.col("diff").alias("grams"),
        )
        ways = F.when(own > alone, F.array(by_own)).otherwise(F.array(by_own, by_all))
        sized = found.select("ref", "class", "root", "n", "common", F.inline(ways))
        return self.with_partner(sized, ["by", "ref"])

    def difference_index(self, parts: DataFrame) -> DataFrame:
        """The prefixes of the differences, one row for each class and group of grams that the same classes hold."""
        key, alike = ["by", "ref", "gram"], ["by", "ref", *ALIKE]
        each = parts.withColumn("gram", F.explode("grams")).drop("grams")
        # Grams that no strong class differs in, or no other class, come first in the order
        # and meet nothing.
        who = each.groupBy(*key).agg(
            F.bit_xor(F.xxhash64("class")).alias("h1"),
            F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("h2"),
            F.count(F.lit(1)).alias("size"),
            F.count_if("strong").alias("met"),
        )
        who = who.filter("size > 1 and met > 0").drop("met")
        rest = [c for c in each.columns if c not in (*key, *alike)]
        groups = each.join(who, key).groupBy(*alike, *rest).agg(F.count(F.lit(1)).alias("grams"))
        # The place of a group is that of its first gram: a group is taken whole.
        by = Window.partitionBy("by", "ref", "class")
        behind = by.orderBy(F.desc("size"), F.desc("h1"), F.desc("h2")).rowsBetween(Window.unboundedPreceding, 0)
        placed = groups.withColumn("place", F.col("d") - F.sum("grams").over(behind) + 1)
        wanted = placed.filter(F.col("place") <= F.when(F.col("strong"), F.col("long")).otherwise(F.col("short")))
        early = (F.col("place") <= F.col("short")).alias("early")
        return settle(wanted.select(*alike, "class", "root", "n", "common", "strong", early), "index")

    def long_links(self, rows: DataFrame, classes: DataFrame) -> DataFrame:
        """The links (u, v, common) between classes of a longer list that are not connected by now,
        or through their reference."""
        rows, sets = self.long_lists(rows, classes)
        found = self.differences(rows, sets)
        listed = self.with_partner(rows, ALIKE).groupBy("class").agg(F.collect_set("h1").alias("lists"))
        listed = settle(listed, "listed")
        index = self.difference_index(self.free_parts(listed, sets).unionByName(self.difference_parts(found)))
        index = index.join(listed, "class", "left")
        key = ["by", "ref", *ALIKE]
        other = index.withColumnsRenamed({c: f"{c}_v" for c in index.columns if c not in key})
        n, n_v, common, common_v = (F.col(c) for c in ("n", "n_v", "common", "common_v"))
        # What two share is of the reference or of neither's part in it.
        most = F.least(common, common_v) + F.least(n - common, n_v - common_v)
        met = (
            (F.col("class") < F.col("class_v"))
            & (F.col("root") != F.col("root_v"))
            & self.similar_size("n", "n_v")
            & self.links(most, n, n_v)
            & (F.col("strong") | F.col("strong_v"))
            & (F.col("early") | ~F.col("strong_v"))
            & (F.col("early_v") | ~F.col("strong"))
            # Only pairs of a longer list are open.
            & ((F.col("by") != "free") | F.arrays_overlap("lists", "lists_v"))
        )
        pairs = settle(index.join(other, key).filter(met).select(F.col("class").alias("u"), F.col("class_v").alias("v")).distinct(), "pairs")
        linked = self.linked(pairs, sets)
        to_ref = found.filter("near and class <> ref").select(
            F.least("ref", "class").alias("u"), F.greatest("ref", "class").alias("v"), "common"
        )
        return linked.unionByName(to_ref)

    def run(self) -> Joined:
        survey = self.survey()
        classes = self.classes(survey)
        lists = self.lists(classes)
        star = self.verify(self.star_pairs(lists, classes), classes)
        open_ = self.open_lists(lists, components(star))
        rest = self.verify(self.cross_pairs(open_), classes)
        with scratch(self.spark):
            more = settle(self.long_links(open_, classes), "links")
            outlast()
        links = settle(star.unionByName(rest).unionByName(more).distinct(), "links")
        parts = components(links).withColumnsRenamed({"node": "class", "root": "component"})
        placed = classes.select("class", *CLASS).join(parts, "class", "left").withColumn(
            "component", F.coalesce("component", "class")
        )
        rows = survey.filter("chunk is null").select("_doc", "_row", *CLASS)
        members = rows.join(placed, CLASS, "left").select("_doc", "_row", "n", "class", "component")
        return Joined(members, classes.select("class", "n", "first_doc"), links)


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def similarity_join(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> Joined:
    """All links between documents, as classes, members and components."""
    return _Join(docs, doc_id, text, rule).run()


def first_of_component(joined: Joined) -> DataFrame:
    """(_doc, _row, n, component_id): the least document id reachable by links. ``_row`` is the hash of the text."""
    roots = joined.members.filter("component is not null").groupBy("component").agg(F.min("_doc").alias("component_id"))
    return joined.members.join(roots, "component", "left").select(
        "_doc", "_row", "n", F.coalesce("component_id", "_doc").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one with the least id.

    Rows with a NULL id stay; of rows that share the least id all stay. Rows that
    share an id but not their text are documents of their own.
    """
    with scratch(docs.sparkSession):
        firsts = first_of_component(similarity_join(docs, rule, doc_id, text))
        gone = firsts.filter("_doc > component_id").select(F.col("_doc").alias("_gone"), F.col("_row").alias("_gone_row"))
        gone = settle(gone.distinct(), "gone", lasting=True)
    same = (docs[doc_id] == gone["_gone"]) & (F.xxhash64(docs[text].cast("binary")) == gone["_gone_row"])
    return docs.join(gone, same, "left_anti")
