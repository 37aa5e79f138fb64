"""Aligning registers by name containment, and enriching measurements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import compute_once

BROADCAST_LIMIT = 64 << 20
# Block sizes, largest first. A name of length n can use block size q if n >= 2q - 1.
BLOCKS = (12, 3)
_SHORT = 2 * BLOCKS[-1] - 2
SEGMENT = 4096
# The characters that mean something in a regular expression.
SPECIAL = r"[\\^$.|?*+()\[\]{}]"


def _text_blocks(text: Column, q: int) -> Column:
    """The consecutive, non-overlapping q-character blocks of a text, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{q}}}"), F.lit(0))


def _name_probes(names: DataFrame, q: int) -> DataFrame:
    """Distinct ``_probe, _at, _size``: the q pieces at places 0 .. q-1 of each name.

    The first whole block of a text that starts inside an occurrence of a name
    is one of these pieces. A piece with its place and the size of the name
    says which part of the text to look up among the names, so names with a
    common beginning share their probes and a text does not meet them one by one.
    """
    pieces = names.select("_name", F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("_at"))
    return pieces.select(
        F.col("_name").substr(F.col("_at") + 1, F.lit(q)).alias("_probe"),
        "_at",
        F.length("_name").alias("_size"),
    ).distinct()


def _segments(text: Column, size: int, overlap: int) -> Column:
    """The text in pieces of ``size`` characters, each with the start of the next.

    A hit then costs the length of a segment, not of the text.
    """
    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    ahead = lambda pieces, i: F.coalesce(F.get(pieces, i + 1).substr(1, overlap), F.lit(""))
    bound = F.transform(F.array(whole), lambda pieces: F.transform(pieces, lambda x, i: F.concat(x, ahead(pieces, i))))
    return F.get(bound, F.lit(0))


def _candidates(hits: DataFrame, q: int, size: int) -> DataFrame:
    """The part of a segment that a probe hit points at, and where it starts in the text."""
    start = F.col("_block") * q - F.col("_at") + 1
    # A part that starts in the overlap belongs to the next segment.
    placed = hits.withColumn("_start", start).filter((F.col("_start") > 0) & (F.col("_start") <= size))
    part = F.col("_segment").substr(F.col("_start"), F.col("_size"))
    # A part cut short by the end of the text belongs to a smaller size.
    whole = placed.withColumn("_part", part).filter(F.length("_part") == F.col("_size"))
    return whole.withColumn("_start", F.col("_start") + F.col("_seg").cast("bigint") * size)


def _short_pieces(text: Column) -> Column:
    """All distinct pieces of up to ``_SHORT`` characters, overlapping ones too."""
    sizes = [
        F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
        for n in range(1, _SHORT + 1)
    ]
    return F.array_distinct(F.concat(*sizes))


def containing_texts(
    names: DataFrame, texts: DataFrame, name: str, text: str, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Rows of ``texts`` with, in ``_name``, each distinct name they contain.

    Exact and case-sensitive. Parts of a text are looked up among the names by
    equality, and a pair is kept once. The size of the name side is measured by a
    job of its own when this is called; up to ``broadcast_limit`` bytes the
    texts are never shuffled. Beyond it distinct texts are matched by a shuffle
    on blocks that carries their hash, not their content.
    """
    wanted = names.select(F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    size = F.length("_name")
    floors = [2 * q - 1 for q in BLOCKS]
    classes = {
        q: (size >= low) & (size < high)
        for q, low, high in zip(BLOCKS, floors, [1 << 31, *floors[:-1]])
    }
    classes[0] = (size >= 1) & (size < floors[-1])
    stats = wanted.agg(
        *(F.count_if(c).alias(f"n{q}") for q, c in classes.items()),
        *(
            F.coalesce(F.sum(F.when(c, F.octet_length("_name") + 40) * max(q, 1)), F.lit(0)).alias(f"b{q}")
            for q, c in classes.items()
        ),
        *(F.max(F.when(c, size)).alias(f"m{q}") for q, c in classes.items()),
        F.count_if(size == 0).alias("empty"),
    ).first()
    in_place = sum(stats[f"b{q}"] for q in classes) <= broadcast_limit

    some = texts.filter(F.col(text).isNotNull())
    found = []
    for q, in_class in classes.items():
        if stats[f"n{q}"] == 0:
            continue
        mine = wanted.filter(in_class)
        probe = _probe_in_place if in_place else _probe_by_shuffle
        found.append(probe(mine, some, text, q, stats[f"m{q}"]))
    if stats["empty"]:
        found.append(some.withColumn("_name", F.lit("")))
    if not found:
        return some.limit(0).withColumn("_name", F.lit(""))
    return reduce(DataFrame.unionByName, found)


def _probe_in_place(names: DataFrame, texts: DataFrame, text: str, q: int, longest: int) -> DataFrame:
    if q == 0:
        pieces = texts.withColumn("_piece", F.explode(_short_pieces(F.col(text))))
        hits = pieces.join(F.broadcast(names), F.col("_piece") == F.col("_name"))
        return hits.drop("_piece")
    size = max(SEGMENT, longest)
    cut = texts.select("*", F.posexplode(_segments(F.col(text), size, longest)).alias("_seg", "_segment"))
    blocks = cut.select("*", F.posexplode(_text_blocks(F.col("_segment"), q)).alias("_block", "_piece"))
    hits = blocks.join(F.broadcast(_name_probes(names, q)), F.col("_piece") == F.col("_probe"))
    found = _candidates(hits, q, size).join(F.broadcast(names), F.col("_part") == F.col("_name"))
    # Only parts that are names look for their first occurrence, which is where
    # that search ends. A plain filter would move below the join.
    first = compute_once(found, {"_first": F.instr(F.col(text), F.col("_name")) == F.col("_start")})
    helpers = ("_seg", "_segment", "_block", "_piece", "_probe", "_at", "_size", "_start", "_part", "_first")
    return first.filter("_first").drop(*helpers)


def _probe_by_shuffle(names: DataFrame, texts: DataFrame, text: str, q: int, longest: int) -> DataFrame:
    keyed = texts.withColumn("_key", F.sha2(F.col(text), 256))
    unique = keyed.select("_key", F.col(text).alias("_text")).dropDuplicates(["_key"])
    if q == 0:
        pieces = unique.select("_key", F.explode(_short_pieces(F.col("_text"))).alias("_name"))
        pairs = pieces.join(names, "_name")
    else:
        size = max(SEGMENT, longest)
        cut = unique.select("_key", F.posexplode(_segments(F.col("_text"), size, longest)).alias("_seg", "_segment"))
        blocks = cut.select(
            "_key", "_seg", F.posexplode(_text_blocks(F.col("_segment"), q)).alias("_block", "_probe")
        )
        hits = blocks.join(_name_probes(names, q), "_probe").drop("_probe")
        parts = _candidates(hits.join(cut, ["_key", "_seg"]), q, size)
        pairs = parts.select("_key", F.col("_part").alias("_name")).join(names, "_name").distinct()
    return keyed.join(pairs, "_key").drop("_key")


# Signs that escaping makes ordinary, and what stands for them while a pattern is taken apart.
_ESCAPED = "\\.|?*+()[]{}^$-/ \"'#&~,:;<>=!@%_"
_HELD = "".join(chr(0xE000 + i) for i in range(len(_ESCAPED)))
_CUT = "\uf8ff"
#: What is not taken apart: quotations, flags and look-around, classes in classes, references and codes.
_OPAQUE = r"\\Q|\(\?(?!:)|\[[^\]]*\[|\\[^dDwWsSbBAzZGhHvVR]"
_STAND_INS = r"[\uE000-\uF8FF]"
_TIMES = r"(?:[?*+]|\{[^}]*\})?[?+]?"
SHORTEST_LITERAL = 3


def required_literals(pattern: Column) -> Column:
    """For each alternative of a regular expression its longest piece that every match holds.

    A match holds at least one of them. NULL where an alternative has none of
    ``SHORTEST_LITERAL`` characters, or the expression has parts that are not taken apart.
    """
    held = pattern
    for sign, stand_in in zip(_ESCAPED, _HELD):
        held = F.replace(held, F.lit("\\" + sign), F.lit(stand_in))
    opaque = pattern.rlike(_STAND_INS) | held.rlike(_OPAQUE)
    out = F.regexp_replace(held, r"\[\^?\]?[^\]]*\]" + _TIMES, _CUT)
    for _ in range(4):  # groups from the inside; what is nested deeper counts as opaque
        out = F.regexp_replace(out, r"\([^()]*\)" + _TIMES, _CUT)
    out = F.regexp_replace(out, r"\\." + _TIMES, _CUT)
    out = F.regexp_replace(out, r"(?s).(?:[?*]|\{[^}]*\})[?+]?", _CUT)
    out = F.regexp_replace(out, r"\+[?+]?|[.^$]", _CUT)
    longest = lambda one: F.array_max(
        F.transform(F.split(one, _CUT), lambda x: F.struct(F.length(x).alias("n"), x.alias("piece")))
    )
    found = F.transform(F.split(out, r"\|"), lambda one: longest(one))
    whole = F.forall(found, lambda x: x["n"] >= SHORTEST_LITERAL)
    plain = F.transform(found, lambda x: F.translate(x["piece"], _HELD, _ESCAPED))
    return F.when(~opaque & ~out.rlike(r"[()\[\]{}\\]") & whole, F.array_distinct(plain))


def _matching_texts(names: DataFrame, texts: DataFrame, name: str, text: str) -> DataFrame:
    """Rows of ``texts`` with, in ``_name``, each name that matches in them as a regular expression.

    A name without special characters matches where it is contained. Of the others
    most name pieces that a match must hold: these are looked up like names, and the
    expression is tried only in the texts that hold one. Only an expression without
    such a piece is tried in every text.
    """
    wanted = names.select(F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    special = F.col("_name").rlike(SPECIAL)
    known = wanted.select(
        "_name",
        special.alias("_special"),
        F.when(special, required_literals(F.col("_name"))).otherwise(F.array("_name")).alias("_pieces"),
    )
    looked_up = known.filter(F.col("_pieces").isNotNull())
    each = looked_up.withColumn("_piece", F.explode("_pieces"))
    hits = containing_texts(each, texts, "_piece", text).withColumnRenamed("_name", "_found")
    met = hits.join(each, F.col("_found") == F.col("_piece"))
    # A text that holds several pieces of one expression is taken at the first of them.
    first = F.get(F.filter("_pieces", lambda x: F.contains(F.col(text), x)), F.lit(0)) == F.col("_piece")
    found = met.filter(first & (~F.col("_special") | F.expr(f"`{text}` rlike _name"))).select(*texts.columns, "_name")
    free = known.filter(F.col("_pieces").isNull()).select("_name")
    if free.isEmpty():
        return found
    return found.unionByName(texts.join(free, F.expr(f"`{text}` rlike _name")))


def contains_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    broadcast_limit: int = BROADCAST_LIMIT,
    regex: bool = False,
) -> DataFrame:
    """Join on "the right name contains the left name" (``how``: inner or left).

    A NULL name matches nothing. Column names of the two sides must differ. With
    ``regex`` the left name is a regular expression that is found in the right one.
    """
    if regex:
        pairs = _matching_texts(left, right, left_on, right_on)
    else:
        pairs = containing_texts(left, right, left_on, right_on, broadcast_limit)
    return left.join(pairs, left[left_on] == pairs["_name"], how).drop("_name")


def align_entities(
    facilities: DataFrame,
    register: DataFrame,
    planned: DataFrame,
    position: str = "position",
) -> DataFrame:
    """Facilities with the state and the fuels of the registers that name them.

    Inputs, each with a ``position`` column giving its row order:
    ``facilities(facility_code, facility_name, lat, lng)``,
    ``register(register_name, state, primary_fuel)`` and
    ``planned(planned_name, future_fuel)``.

    A facility needs a register row; planned rows are optional. Per facility and
    state the list holds all primary fuels, then the known future fuels, over the
    distinct (primary, future) pairs in order of first appearance, repeats kept.
    Facilities without a place or state are left out.

    Both registers are reduced to distinct (name, attribute) rows before they are
    matched, and each match to distinct attributes per facility, so the pairs
    that are formed are bounded by the fuel vocabulary. The first position of a
    pair is the pair of first positions, as a planned match depends on the name
    only.
    """
    first = F.min(position)
    reg = register.groupBy("register_name", "state", "primary_fuel").agg(first.alias("_reg_pos"))
    plan = planned.groupBy("planned_name", "future_fuel").agg(first.alias("_plan_pos"))

    place = ["facility_name", "facility_code", "lat", "lng", "state"]
    located = facilities.drop(position).dropDuplicates().dropna(subset=place[:4])
    matched = contains_join(located, reg, "facility_name", "register_name")
    primary = matched.dropna(subset=["state"]).groupBy(*place, "primary_fuel").agg(
        F.min("_reg_pos").alias("_reg_pos")
    )
    names = located.select(F.col("facility_name").alias("_wanted")).distinct()
    future = (
        contains_join(names, plan, "_wanted", "planned_name")
        .groupBy("_wanted", "future_fuel")
        .agg(F.min("_plan_pos").alias("_plan_pos"))
    )
    both = primary.join(future, F.col("facility_name") == F.col("_wanted"), "left")
    ordered = F.transform(
        F.array_sort(
            F.collect_list(F.struct("_reg_pos", "_plan_pos", "primary_fuel", "future_fuel"))
        ),
        lambda s: F.struct(s["primary_fuel"].alias("p"), s["future_fuel"].alias("f")),
    )
    listed = both.groupBy(*place).agg(ordered.alias("_fuels"))
    fuels = F.concat(
        F.col("_fuels.p"), F.filter(F.col("_fuels.f"), lambda f: f.isNotNull())
    )
    return listed.select(*place, fuels.alias("fuel_list"))


def enrich(
    measures: DataFrame, aligned: DataFrame, on: str | Sequence[str] = "facility_code", dedupe: bool = False
) -> DataFrame:
    """Inner join with the aligned facilities.

    A code listed in two states doubles its measurements; ``dedupe`` keeps one
    row per code (first by state). No broadcast hint: Spark compares the size of
    the facility side with its own limit, and splits a skewed code otherwise.
    """
    keys = [on] if isinstance(on, str) else list(on)
    dim = aligned
    if dedupe:
        rest = [c for c in aligned.columns if c not in keys]
        lead = ["state", *(c for c in rest if c != "state")] if "state" in rest else rest
        dim = aligned.groupBy(*keys).agg(F.min(F.struct(*lead)).alias("_d")).select(
            *keys, *(F.col(f"_d.{c}") for c in rest)
        )
    return measures.join(dim, keys)
