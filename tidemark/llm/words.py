"""Word hashes of many texts at once, inside a task.

Texts come as UTF-8 bytes. A word is a run of the bytes that a table marks, with
A-Z lower-cased. Its hash is a sum of per-position random multiples of its bytes,
modulo 2**64, so a whole block of text is hashed by a few array operations. Equal
words have equal hashes; two different words collide with a chance below 2**-56.

Memory is bounded by a block of text and the hashes of the texts in it: texts are
put into blocks of about ``BLOCK`` bytes, and a longer text is read in pieces that
end at a separator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 20
SLOTS = 1 << 24

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWERED = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
#: Letters, digits and everything beyond ASCII.
ALNUM = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122))
#: Everything but space, tab, line ends, vertical tab and form feed.
NON_BLANK = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed random permutation of 64-bit numbers (the splitmix64 finalizer)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = mixed(np.arange(256, dtype=np.uint64)) | np.uint64(1)


def _factors(n: int) -> np.ndarray:
    return _FACTORS if n <= len(_FACTORS) else mixed(np.arange(n, dtype=np.uint64)) | np.uint64(1)


def lowered(raw: np.ndarray) -> np.ndarray:
    """The numbers that stand for bytes in hashes, equal for A-Z and a-z."""
    return _LOWERED[raw]


def word_sums(letters: np.ndarray) -> np.ndarray:
    """The hash that ``word_parts`` gives to each row of ``lowered`` bytes."""
    n = letters.shape[1]
    return mixed((_factors(n)[:n] * letters).sum(axis=1, dtype=np.uint64))


def word_parts(
    data: bytes, table: np.ndarray, prefixes: Sequence[int] = ()
) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Start and hash of each word of a block, and for each length in ``prefixes``
    which words are longer and the hashes of their first so many bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = table[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, dtype=np.uint64)
        return starts, none, [(starts, none) for _ in prefixes]
    at = np.flatnonzero(inside)
    begin = np.flatnonzero(first[at])
    lengths = np.diff(np.append(begin, len(at)))
    place = at - np.repeat(starts, lengths)
    parts = _factors(int(place.max()) + 1)[place] * _LOWERED[raw[at]]
    short = []
    for n in prefixes:
        which = np.flatnonzero(lengths > n)
        cells = begin[which][:, None] + np.arange(n)
        short.append((which, mixed(parts[cells].sum(axis=1, dtype=np.uint64))))
    return starts, mixed(np.add.reduceat(parts, begin)), short


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that a task holds copies of fewer texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_hashes(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a block."""
    return word_parts(data, table)[:2]


def _pieces(text: bytes, table: np.ndarray) -> Iterator[bytes]:
    """A long text in pieces that do not cut a word."""
    raw = np.frombuffer(text, dtype=np.uint8)
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        while end < len(text):
            gap = np.flatnonzero(~table[raw[end : end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(text), end + BLOCK)
        yield text[at:end]
        at = end


@dataclass
class Block:
    """Hashes of some neighbouring texts; text ``i`` has ``hashes[ends[i-1]:ends[i]]``."""

    first: int
    hashes: np.ndarray
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.append(0, self.ends[:-1])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def blocks(texts: Sequence[bytes | None], table: np.ndarray) -> Iterator[Block]:
    """Hash the words of all texts (None: no words), block by block, in order."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= BLOCK):
            size += len(texts[end] or b"") + 1
            end += 1
        if end == at + 1 and size > BLOCK:
            found = [word_hashes(piece, table)[1] for piece in _pieces(texts[at], table)]
            hashes = np.concatenate(found)
            yield Block(at, hashes, np.array([len(hashes)]))
        else:
            group = [t or b"" for t in texts[at:end]]
            starts, hashes = word_hashes(b"\n".join(group), table)
            limits = np.cumsum([len(t) + 1 for t in group])
            yield Block(at, hashes, np.searchsorted(starts, limits))
        at = end


def slot_bits(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size (2 MB) that marks the slots of the column's hashes.

    ``SLOTS / 64`` numbers at most come to the driver. More hashes than slots make
    the bitmap less selective, never wrong: what it marks by chance meets no row in
    the join that follows.
    """
    slot = F.pmod(F.col(column), F.lit(SLOTS))
    bit = F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")
    found = rows.select(F.floor(slot / 64).cast("int").alias("at"), bit.alias("bit"))
    found = found.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(SLOTS // 64, dtype=np.uint64)
    bits[found["at"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


def marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(SLOTS - 1)
    return ((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
