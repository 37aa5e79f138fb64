"""Conversation repair: the lattice, segments and whole queries against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import conversation_repair as cr
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_repair(rows):
    """Cheapest edits by a table of best (cost, letters) per state; rows are (role, text) in order."""
    blank = duplicate = truncated = illegal = 0
    seen, marks = set(), []
    for role, text in rows:
        bare = BLANK.sub("", text)
        b, d = not bare, bool(bare) and (role, text) in seen
        t = bool(bare) and not d and bare[-1] not in ".!?"
        seen.add((role, text))
        blank, duplicate, truncated = blank + b, duplicate + d, truncated + t
        marks.append((b or d, t))
    for (r1, _), (r2, _) in zip(rows, rows[1:]):
        illegal += r1[:1] + r2[:1] not in ("su", "ua", "au")
    # States as strings: what has been put out, shortened to its last initial.
    best = {"": (0, "", ())}

    def offer(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def follows(state, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and initial != ""

    def insertions(table):
        for _ in range(3):
            for state, (cost, letters, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if follows(state, role[0]):
                        offer(table, role[0], (cost + 3, letters + "I", (*out, (role, ""))))

    for (role, text), (must_go, cut) in zip(rows, marks):
        insertions(best)
        after = {}
        for state, (cost, letters, out) in best.items():
            offer(after, state, (cost + 4, letters + "D", out))
            if must_go:
                continue
            more = 3 * cut
            if follows(state, role[:1]):
                offer(after, role[:1], (cost + more, letters + "K", (*out, (role, text))))
            for new in ("user", "assistant"):
                if follows(state, new[0]):
                    offer(after, new[0], (cost + 3 + more, letters + "R", (*out, (new, text))))
        best = after
    insertions(best)
    cost, letters, out = min((best[s][:2] + (best[s][2],) for s in ("", "a") if s in best), key=lambda e: e[:2])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return blank, duplicate, truncated, illegal, cost, letters, digest


def coded(rows):
    """Rows as the lattice sees them."""
    seen, out = set(), []
    for role, text in rows:
        bare = BLANK.sub("", text)
        must_go = not bare or (role, text) in seen
        seen.add((role, text))
        code = "sua".find(role[0]) if role[:1] in ("s", "u", "a") else 3
        out.append(code + (cr.MUST_GO if must_go else cr.IS_CUT if bare[-1] not in ".!?" else 0))
    return bytes(out)


def some_rows(rng, n):
    roles = rng.choice([["user", "assistant"], ["system", "user", "assistant", "tool"], ["assistant", "system"], ["user"]])
    texts = ["One.", "Two!", "cut", "", " ", "Three?", "four"]
    return [(rng.choice(roles), rng.choice(texts) + str(rng.randrange(9)) * rng.randrange(2) + rng.choice([".", ""])) for _ in range(n)]


def test_lattice():
    rng = random.Random(3)
    for _ in range(1500):
        rows = some_rows(rng, rng.randrange(0, 12))
        codes = coded(rows)
        ways, _, costs = cr.solved(codes, cr.FINAL, True)
        *_, cost, letters, _ = plain_repair(rows)
        assert (costs[0], ways[0]) == (cost, letters), rows


def test_all_short_conversations():
    """Every sequence of up to four rows over the kinds of rows there are."""
    kinds = list(itertools.product("suax", ("Fine.", "cut", "")))
    for n in range(4):
        for picked in itertools.product(kinds, repeat=n):
            rows = [(i, t and f"{k}{t}") for k, (i, t) in enumerate(picked)]
            ways, _, costs = cr.solved(coded(rows), cr.FINAL, True)
            *_, cost, letters, _ = plain_repair(rows)
            assert (costs[0], ways[0]) == (cost, letters), rows


def test_prices_are_feasible_and_tight():
    rng = random.Random(4)
    for _ in range(300):
        codes = coded(some_rows(rng, rng.randrange(1, 30)))
        price = cr.prices(codes, cr.FINAL, True)
        for i in range(len(codes) + 1):
            for state in range(4):
                onward = [cost + price[j][t] for _, cost, j, t in cr.arcs(codes, i, state, True)]
                onward += [cr.FINAL[state]] if i == len(codes) else []
                assert price[i][state] == min(onward)


def test_segments_cross_as_one():
    rng = random.Random(5)
    for _ in range(60):
        codes = coded(some_rows(rng, rng.randrange(2, 40)))
        at = rng.randrange(1, len(codes))
        whole, left, right = (cr.crossing(c) for c in (codes, codes[:at], codes[at:]))
        for first, last in itertools.product(range(4), repeat=2):
            # Insertions behind the last row belong to the next segment, so the halves meet exactly.
            joint = min(left[4 * first + m] + right[4 * m + last] for m in range(4))
            assert min(joint, cr.FAR) == whole[4 * first + last]


def test_long_conversation_takes_linear_work():
    codes = coded([("assistant", f"cut {i}") for i in range(3000)])
    price = cr.prices(codes, cr.FINAL, True)
    letters, state = cr.trace(codes, cr.FINAL, True, price, cr.START)
    assert state in (cr.START, cr.ANSWERED) and letters.count("I") + 3000 == len(letters)


TURNS = "conv_id long, turn long, role string, text string, copy int, pos string, code string, conv string, seg int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", "c", "v", 2) for r in rows], TURNS)


def plain_damage(rows):
    space = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in rows:
        drawn = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        out.setdefault(conv, [])
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        role = "user" if drawn == 4 else role
        out[conv] += [(turn, role, text)] * (2 if drawn == 3 else 1)
    return out


def plain_query(rows):
    want = {}
    for conv, left in plain_damage(rows).items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        known = [t for t, _, _ in left if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        want[conv] = (gaps, *plain_repair([(r, t) for _, r, t in left]))
    return want


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    rows = df.collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    df = QUERIES["op13_repair_conversations"](spark, SF)
    assert df.columns == ["conv_id", *COLUMNS]
    assert {t for c, t in df.dtypes if c in COLUMNS[:6]} == {"bigint"}
    assert found(df) == plain_query(rows)


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_odd_tables(spark, monkeypatch, segment):
    """NULLs everywhere, equal and missing turns, one long conversation, one that loses all rows."""
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rng = random.Random(segment)
    rows = [(1, i, *r) for i, r in enumerate(some_rows(rng, 900))]
    rows += [(c, i, *r) for c in range(100, 160) for i, r in enumerate(some_rows(rng, rng.randrange(1, 9)))]
    rows += [(2, None, "user", "Hi."), (2, 5, None, None), (2, 9, "assistant", "x" * 100_000), (3, None, None, None)]
    rows += [(None, 1, "user", "Who?"), (None, 2, "assistant", "Nobody."), (4, 7, "", "Empty role.")]
    rows += [(5, 3, "user", "Again."), (5, 3, "user", "Again."), (5, 4, "assistant", "Yes.")]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Lost."))
    got = found(cr.repair_damaged(turns_of(spark, rows).repartition(5)))
    want = plain_query(rows)
    assert got == want
    assert want[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty(spark):
    assert cr.repair_damaged(turns_of(spark, [])).collect() == []
