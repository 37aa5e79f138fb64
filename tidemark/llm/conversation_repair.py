"""Repair the structure of conversations with the fewest edits.

Wanted is a conversation of the form ``(s?(ua)+)?`` over the initials of its roles,
without blank or repeated messages. Rows may be kept (K, free), given the role user or
assistant (R, 3) or deleted (D, 4; blank and repeated ones must be), and empty messages
of a user or an assistant inserted anywhere (I, 3). A truncated row that is not deleted
costs 3 more.

The edits are shortest paths through a lattice of (rows read, state of the form), found
by the auction algorithm: a path grows at its end while the price of the end node equals
the cheapest arc plus the price behind it, and otherwise raises that price and gives the
node up. Auctions start from the last nodes and go backwards, and a node whose path has
reached the sink settles its price for all others, so the work is linear in the lattice.
The converged prices are the costs to go; arcs whose cost is the difference of their
prices are on cheapest paths, and following the least letter along them gives the
ASCII-least of all cheapest edit strings.

Conversations of any length: rows are numbered and repeats found by sliced order
(``operators.ordered``). The lattice is cut into segments of ``SEGMENT`` rows. Each
segment of a longer conversation gives the least costs from each of its 4 first states
to each of its 4 last ones; a pass over these small rows from the back gives the costs
to go at every cut, and one from the front the state at every cut. A segment is thus
priced and traced by itself. The last pass streams the rows of a conversation through
one digest, which has to be done in order, and keeps no row.

Defined results: NULL roles and texts count as one space, and a NULL in a
conversation's id or a turn is one space in what the damage is drawn from; a NULL id is
a conversation of its own, NULL turns come first. Equal turns are ordered by a hash of
role and text, so equal rows stay neighbours. Messages are equal if 128 bits of hashes of role
and text are. Without rows the cost is 0 and the edits are empty. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators import ordered
from ..session import settle
from .text import BLANKS

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
FAR = 1 << 60

# States: nothing yet, after the system message, after a user's, after an assistant's.
START, OPENED, ASKED, ANSWERED = range(4)
#: Costs to go behind the last row.
FINAL = (0, FAR, FAR, 0)
#: State after a message of the user or the assistant, and who that is.
NEXT = {START: ASKED, OPENED: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
ROLE = {ASKED: "user", ANSWERED: "assistant"}
#: A row as a number: its role's initial, and whether it must go or is truncated.
INITIALS = "sua"
MUST_GO, IS_CUT = 4, 8


# -- the lattice ---------------------------------------------------------------


def _after(state: int, initial: int) -> int | None:
    """The state when a row is kept, if it may be."""
    if initial == 0:
        return OPENED if state == START else None
    if initial == 1:
        return ASKED if state != ASKED else None
    if initial == 2:
        return ANSWERED if state == ASKED else None
    return None


def arcs(codes: bytes, i: int, state: int, may_end: bool) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows read, state) of the arcs out of a node, letters ascending."""
    inside = i < len(codes)
    if inside:
        yield "D", DELETE, i + 1, state
    if inside or may_end:
        yield "I", INSERT, i, NEXT[state]
    if inside and not codes[i] & MUST_GO:
        more = TRUNCATED if codes[i] & IS_CUT else 0
        kept = _after(state, codes[i] & 3)
        if kept is not None:
            yield "K", KEEP + more, i + 1, kept
        yield "R", REROLE + more, i + 1, NEXT[state]


def prices(codes: bytes, to_go: tuple[int, ...], may_end: bool) -> list[list[int]]:
    """The cost to go of every node, by auctions; ``to_go`` are those behind the last row.

    All prices start at 0, so no arc is cheaper than the difference of its prices, and
    raising the end of a path to its cheapest way on keeps that so. Once somebody has
    asked there is no way back, so without a way on from there those nodes are out; an
    auction needs that, as insertions could raise their prices for ever.
    """
    n = len(codes)
    lost = to_go[ASKED] >= FAR and to_go[ANSWERED] >= FAR
    price = [[0, 0, FAR, FAR] if lost else [0] * 4 for _ in range(n + 1)]
    settled = [[False, False, lost, lost] for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for state in range(4):
            path = [(i, state)]
            while path:
                at, s = path[-1]
                if settled[at][s]:
                    break
                best, ahead = (to_go[s], None) if at == n else (FAR, None)
                for _, cost, j, t in arcs(codes, at, s, may_end):
                    if cost + price[j][t] < best:
                        best, ahead = cost + price[j][t], (j, t)
                if price[at][s] < best:
                    price[at][s] = best
                    if len(path) > 1:
                        path.pop()  # contraction
                elif ahead is None:
                    break  # the sink, or nowhere to go
                else:
                    path.append(ahead)  # extension
            for at, s in path:
                settled[at][s] = True
    return price


def trace(codes: bytes, to_go: tuple[int, ...], may_end: bool, price: list[list[int]], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from the first row in ``state``, and the last state."""
    if price[0][state] >= FAR:
        return "", -1
    letters, i = [], 0
    while not (i == len(codes) and price[i][state] == to_go[state]):
        for letter, cost, j, t in arcs(codes, i, state, may_end):
            if price[i][state] == cost + price[j][t]:
                letters.append(letter)
                i, state = j, t
                break
    return "".join(letters), state


@lru_cache(maxsize=1 << 14)
def crossing(codes: bytes) -> tuple[int, ...]:
    """Least costs from each first to each last state, 16 numbers."""
    columns = []
    for last in range(4):
        to_go = tuple(0 if s == last else FAR for s in range(4))
        columns.append(prices(codes, to_go, False)[0])
    return tuple(min(columns[last][first], FAR) for first in range(4) for last in range(4))


@lru_cache(maxsize=1 << 14)
def solved(codes: bytes, to_go: tuple[int, ...], may_end: bool) -> tuple[tuple[str, ...], tuple[int, ...], tuple[int, ...]]:
    """Edits, last state (-1: no way) and cost for each first state."""
    price = prices(codes, to_go, may_end)
    ways = [trace(codes, to_go, may_end, price, s) for s in range(4)]
    return tuple(w for w, _ in ways), tuple(s for _, s in ways), tuple(min(p, FAR) for p in price[0])


def row_edits(letters: str) -> list[str]:
    """The letters row by row: insertions before a row, its own letter; the rest goes to the last row."""
    rows, begin = [], 0
    for end, letter in enumerate(letters, 1):
        if letter != "I":
            rows.append(letters[begin:end])
            begin = end
    if begin < len(letters) and rows:
        rows[-1] += letters[begin:]
    return rows


# -- rows ----------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copy): the rows after the damage their ids draw."""
    space = F.lit(" ")
    word = lambda c: F.coalesce(F.col(c).cast("string"), space)
    drawn = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = turns.select(
        F.col("conv_id").alias("conv"), "turn", word("role").alias("role"), word("text").alias("text"), drawn.alias("drawn")
    ).filter("drawn <> 0")
    text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Rows of (conv, turn, role, text, copy) with ``pos`` from 0 in each conversation, and what
    is needed to judge them: h1 and h2, hashes of role and text, and the last letter."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    keyed = rows.withColumns(
        {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role"), "last": F.right(bare, F.lit(1))}
    )
    out = ordered.number_rows(keyed, ["turn", "h1", "h2", "copy"], ["conv"], "pos")
    return settle(out.withColumn("pos", F.col("pos") - 1).drop("copy"), "turns")


def judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, pos, blank, duplicate, truncated, code) of numbered rows; the first fault counts."""
    narrow = rows.select("conv", "turn", "pos", "h1", "h2", "last", F.left("role", F.lit(1)).alias("initial"))
    seen = ordered.previous_values(narrow, ["pos"], {"before": "pos"}, ["conv", "h1", "h2"])
    blank = F.col("last") == ""
    again = ~blank & F.col("before").isNotNull()
    cut = ~blank & ~again & ~F.col("last").isin(".", "!", "?")
    initial = F.coalesce(*(F.when(F.col("initial") == c, i) for i, c in enumerate(INITIALS)), F.lit(3))
    code = initial + F.when(blank | again, MUST_GO).otherwise(0) + F.when(cut, IS_CUT).otherwise(0)
    return seen.select("conv", "turn", "pos", blank.alias("blank"), again.alias("duplicate"), cut.alias("truncated"), code.alias("code"))


def segments(rows: DataFrame) -> DataFrame:
    """(conv, seg, codes): the rows' codes in order, ``SEGMENT`` at most."""
    seg = F.floor(F.col("pos") / SEGMENT)
    listed = F.array_sort(F.collect_list(F.struct("pos", "code")))
    groups = rows.groupBy("conv", seg.alias("seg")).agg(listed.alias("rows"))
    return groups.select("conv", "seg", F.col("rows.code").alias("codes"))


# -- segment passes ------------------------------------------------------------


def _schema(rows: DataFrame, ddl: str) -> StructType:
    return StructType([StructField("conv", rows.schema["conv"].dataType), *StructType.fromDDL(ddl).fields])


def _batch(conv: list, kind: pa.DataType, schema: StructType, columns: list[list]) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    names = schema.names
    arrays = [pa.array(conv, kind)]
    arrays += [pa.array(c, types[f.dataType.simpleString()]) for c, f in zip(columns, schema.fields[1:])]
    return pa.RecordBatch.from_arrays(arrays, names)


def _streamed(rows: DataFrame, *order) -> DataFrame:
    """All rows of a conversation in one task, in order; the tasks read them one after the other."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def costs_to_go(segs: DataFrame) -> DataFrame:
    """(conv, seg, codes, to_go, ends): each segment with the costs to go behind it."""
    schema = _schema(segs, "seg bigint, codes array<bigint>, cross array<bigint>")
    out = _schema(segs, "seg bigint, codes array<bigint>, to_go array<bigint>, ends boolean")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, seg = b["codes"].to_pylist(), b["seg"].to_pylist()
            found = [None if s == 0 and len(c) < SEGMENT else list(crossing(bytes(c))) for s, c in zip(seg, codes)]
            yield _batch(b["conv"].to_pylist(), b["conv"].type, schema, [seg, codes, found])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, to_go = object(), FINAL
        for b in batches:
            columns = [b[c].to_pylist() for c in ("conv", "seg", "codes", "cross")]
            behind, ends = [], []
            for c, _, _, matrix in zip(*columns):
                ends.append(c != conv)
                to_go = FINAL if c != conv else to_go
                conv = c
                behind.append(list(to_go))
                if matrix:
                    to_go = tuple(min(min(matrix[4 * s + t] + to_go[t] for t in range(4)), FAR) for s in range(4))
                if matrix and ends[-1]:
                    # The last segment may also insert behind its last row.
                    to_go = solved(bytes(columns[2][len(behind) - 1]), FINAL, True)[2]
            yield _batch(columns[0], b["conv"].type, out, [columns[1], columns[2], behind, ends])

    crossed = segs.mapInArrow(cross, schema)
    return _streamed(crossed, F.col("seg").desc()).mapInArrow(back, out)


def traced(priced: DataFrame) -> DataFrame:
    """(conv, seg, cost, letters, edits, illegal): the edits of each segment, row by row.

    ``cost`` is that of the conversation, on its first segment; ``illegal`` counts the
    neighbours whose initials do not follow each other.
    """
    out = _schema(priced, "seg bigint, cost bigint, letters string, edits array<string>, illegal bigint")
    legal = {(0, 1), (1, 2), (2, 1)}

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, last = object(), START, None
        for b in batches:
            columns = [b[c].to_pylist() for c in ("conv", "seg", "codes", "to_go", "ends")]
            cost, letters, edits, illegal = [], [], [], []
            for c, seg, codes, to_go, ends in zip(*columns):
                if c != conv or seg == 0:
                    conv, state, last = c, START, None
                ways, exits, costs = solved(bytes(codes), tuple(to_go), ends)
                cost.append(costs[state] if seg == 0 else 0)
                letters.append(ways[state])
                edits.append(row_edits(ways[state]))
                state = exits[state]
                initials = [x & 3 for x in codes]
                before = initials[:-1] if last is None else [last, *initials[:-1]]
                after = initials[1:] if last is None else initials
                illegal.append(sum(pair not in legal for pair in zip(before, after)))
                last = initials[-1]
            yield _batch(columns[0], b["conv"].type, out, [columns[1], cost, letters, edits, illegal])

    return _streamed(priced, "seg").mapInArrow(forth, out)


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): a digest of the repaired ``role:text`` lines.

    ``edits`` holds (conv, pos, edit). The texts of a conversation pass by in order.
    """
    out = _schema(rows, "repaired_sha256 string")
    both = rows.select("conv", "pos", F.lit(None).cast("string").alias("edit"), "role", "text").unionByName(
        edits.select("conv", "pos", "edit"), allowMissingColumns=True
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, edit, digest, first = None, START, "", None, True
        kind = None

        def add(line: str) -> None:
            nonlocal first
            digest.update((line if first else "\n" + line).encode())
            first = False

        for b in batches:
            done, hexes, kind = [], [], b["conv"].type
            for c, this, role, text in zip(*(b[x].to_pylist() for x in ("conv", "edit", "role", "text"))):
                if digest is None or c != conv:
                    if digest is not None:
                        done.append(conv)
                        hexes.append(digest.hexdigest())
                    conv, state, digest, first = c, START, hashlib.sha256(), True
                if this is not None:  # comes before its row
                    edit = this
                    continue
                for letter in edit:
                    if letter == "I":
                        state = NEXT[state]
                        add(ROLE[state] + ":")
                    elif letter == "R":
                        state = NEXT[state]
                        add(f"{ROLE[state]}:{text}")
                    elif letter == "K":
                        state = _after(state, INITIALS.find(role[:1]))
                        add(f"{role}:{text}")
            yield _batch(done, kind, out, [hexes])
        if digest is not None:
            yield _batch([conv], kind, out, [[digest.hexdigest()]])

    return _streamed(both, "pos", F.col("edit").isNull()).mapInArrow(run, out)


def repair(turns: DataFrame) -> DataFrame:
    """Judge and repair the conversations of rows (conv, turn, role, text, copy), as ``damaged`` gives.

    (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a conversation.
    """
    rows = numbered(turns)
    faults = settle(judged(rows), "faults")
    found = settle(traced(costs_to_go(segments(faults))), "edits")
    count = lambda c: F.count_if(c).alias(c)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    stats = faults.groupBy("conv").agg(gaps.alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    parts = F.array_sort(F.collect_list(F.struct("seg", "letters")))
    audits = found.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda x: x["letters"]), "").alias("audit"),
    )
    each = found.select("conv", "seg", F.posexplode("edits").alias("at", "edit"))
    each = each.select("conv", (F.col("seg") * SEGMENT + F.col("at")).alias("pos"), "edit")
    out = stats
    for side in (audits, digests(rows, each)):
        side = side.withColumnRenamed("conv", "_of")
        out = out.join(side, F.col("conv").eqNullSafe(F.col("_of"))).drop("_of")
    return out


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair`` after ``damaged``, with a row for every conversation of (conv_id, turn, role, text)."""
    found = repair(damaged(turns))
    every = turns.select(F.col("conv_id").alias("conv_id")).distinct()
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *zero.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
