"""Which keys have been written, in space and time that follow the batch and not the history.

Beside the written keys, kept by day, stands a Bloom filter for each day, as rows of
(word number, 64 bits). A batch's keys are looked up in the filters; only keys that a
filter may hold are joined, and only with the keys of that day. A filter that fills up
is built anew with twice the words, so the share of false hits, which cost a join and
never a message, stays below 2 %.

A batch reads the filters of all days and the keys of the days it repeats; it writes the
filters of the days it adds to. All of it changes with the manifest of ``versions``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .versions import MERGE, Versions

HASHES = 4
#: A filter has 64 bits for so many keys.
KEYS_PER_WORD = 6
FIRST_WORDS = 1 << 10
NO_DAY = "none"


def day_of(at: Column) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(NO_DAY))


def _places(words: int) -> Column:
    """The distinct bits of a key in a filter of so many words."""
    return F.array_distinct(F.array(*(F.pmod(F.xxhash64(F.lit(i), "key"), F.lit(words * 64)) for i in range(HASHES))))


def _bit(place: str) -> Column:
    return F.expr(f"shiftleft(1L, cast(pmod({place}, 64) as int))")


def bits_of(keys: DataFrame, words: int) -> DataFrame:
    """(day, word, bits) of (day, key)."""
    each = keys.select("day", F.explode(_places(words)).alias("place"))
    return each.groupBy("day", F.shiftright("place", 6).alias("word")).agg(F.bit_or(_bit("place")).alias("bits"))


def may_hold(keys: DataFrame, bits: DataFrame, words: int) -> DataFrame:
    """(key, day) for each filter of ``bits`` that has all of a key's bits."""
    probes = keys.withColumn("places", _places(words)).select("key", F.size("places").alias("n"), F.explode("places").alias("place"))
    probes = probes.withColumn("word", F.shiftright("place", 6))
    hits = probes.join(bits, "word").filter(F.col("bits").bitwiseAND(_bit("place")) != 0)
    return hits.groupBy("key", "day", "n").agg(F.count(F.lit(1)).alias("found")).filter("found = n").select("key", "day")


class SeenKeys:
    """The keys written so far, below a path. ``key_type`` is that of the column ``key``."""

    def __init__(self, versions: Versions, key_type: str):
        self.versions = versions
        self.keys_schema = f"key {key_type}, day string"
        self.bits_schema = "day string, word bigint, bits bigint"

    def known(self, state: dict, keys: DataFrame) -> DataFrame | None:
        """The keys among ``keys`` (distinct ``key``) that a state holds; None if it holds none."""
        days = state.get("days", {})
        parts = []
        for words in sorted({d["words"] for d in days.values()}):
            filters = [d["bits"] for d in days.values() if d["words"] == words]
            parts.append(may_hold(keys, self.versions.read(filters, self.bits_schema), words))
        if not parts:
            return None
        maybe = reduce(DataFrame.unionByName, parts).persist()
        try:
            # As many rows as there are days.
            touched = [r.day for r in maybe.select("day").distinct().collect()]
            if not touched:
                return None
            held = self.versions.read([f for d in touched for f in days[d]["keys"]], self.keys_schema).withColumnsRenamed(
                {"key": "held", "day": "held_day"}
            )
            same = F.col("key").eqNullSafe(F.col("held")) & (F.col("day") == F.col("held_day"))
            # Written, as the lookup would otherwise be done again by whoever reads this.
            folder = self.versions.write(maybe.join(held, same).select("key").distinct(), "repeats", state["number"])
        finally:
            maybe.unpersist()
        return self.versions.read([folder], self.keys_schema.split(",")[0])

    def add(self, state: dict, new: DataFrame) -> dict:
        """The state with the keys of ``new`` (key, day) added; ``new`` is read more than once."""
        number, days = state["number"], dict(state.get("days", {}))
        counts = {r.day: r.n for r in new.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            return state
        full = [d for d in counts if d in days and len(days[d]["keys"]) >= MERGE]
        rows = new.select("key", "day")
        if full:
            rows = rows.unionByName(self.versions.read([f for d in full for f in days[d]["keys"]], self.keys_schema))
        keys = self.versions.write(rows.withColumn("d", F.col("day")).repartition("d"), "keys", number, "d")
        for d, n in counts.items():
            old = days.get(d, {"n": 0, "words": 0, "bits": None, "keys": []})
            words = max(old["words"], FIRST_WORDS)
            while words * KEYS_PER_WORD < old["n"] + n:
                words *= 2
            lists = ([] if d in full else old["keys"]) + [f"{keys}/d={d}"]
            days[d] = {"n": old["n"] + n, "words": words, "bits": old["bits"] if words == old["words"] else None, "keys": lists}
        added = self.versions.read([f"{keys}/d={d}" for d in counts], self.keys_schema)
        parts = []
        for words in sorted({days[d]["words"] for d in counts}):
            same = [d for d in counts if days[d]["words"] == words]
            grown = [d for d in same if days[d]["bits"] is None]
            held = [f for d in grown for f in days[d]["keys"] if not f.startswith(keys)]
            some = added.filter(F.col("day").isin(same))
            parts.append(bits_of(some.unionByName(self.versions.read(held, self.keys_schema)) if held else some, words))
            kept = [days[d]["bits"] for d in same if days[d]["bits"] is not None]
            if kept:
                parts.append(self.versions.read(kept, self.bits_schema))
        bits = reduce(DataFrame.unionByName, parts).groupBy("day", "word").agg(F.bit_or("bits").alias("bits"))
        folder = self.versions.write(bits.withColumn("d", F.col("day")).repartition("d"), "bits", number, "d")
        for d in counts:
            days[d] = days[d] | {"bits": f"{folder}/d={d}"}
        return state | {
            "days": days,
            "folders": {
                "keys": [[f, 0] for d in days.values() for f in d["keys"]],
                "bits": [[d["bits"], 0] for d in days.values()],
                "repeats": [],
            },
        }
