"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. What speaks for a label are coarse features of the line
and of the lines before and after it (length, letters, capitals, digits, symbols,
word length, repeated words), and the label of the line before. Forward-backward
gives each line's chance of being good; the document's score is the mean of these,
weighted by length.

Only documents are labelled, so in fitting every line takes its document's label.
The model is fitted on at most ``max_documents`` labelled documents, those with the
smallest hash of their id; their binned features come to the driver, no text does.
Scoring is one pass over whole texts without a shuffle.

Defined results: a NULL text counts as empty, an empty text is one empty line and
gets a score like any other; repeated rows get equal scores; rows without a label
are not fitted on; without labelled rows of both kinds every score is the share of
good labels, or 1 without any. Features see bytes, never ids, sources or languages.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .text import free_name
from .words import ALNUM, BLOCK, NON_BLANK, word_hashes

_B = np.arange(256)
_ASCII_LETTER = ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122))
_ODD = np.isin(_B, np.frombuffer(b"*$&%#|!@^~+=<>{}[]\\/_", dtype=np.uint8))
#: Sums per line: bytes, characters, letters, capitals, ASCII letters, digits, odd symbols;
#: words, words like one of the three before, words without letter or digit, words with odd symbols.
_BYTE_SUMS = [
    np.ones(256, bool),
    (_B < 128) | (_B >= 192),
    _ASCII_LETTER | (_B >= 192),
    (_B >= 65) & (_B <= 90),
    _ASCII_LETTER,
    (_B >= 48) & (_B <= 57),
    _ODD,
]
_SUMS = len(_BYTE_SUMS) + 4
#: Upper bin limits of each feature.
_EDGES = [
    np.array([0.5, 20, 60, 150, 400, 1500]),
    np.array([0.3, 0.6, 0.7, 0.75, 0.8, 0.85]),
    np.array([0.02, 0.05, 0.1, 0.3, 0.7]),
    np.array([0.001, 0.02, 0.05, 0.15, 0.4]),
    np.array([0.001, 0.01, 0.03, 0.08, 0.2]),
    np.array([0.5, 3.5, 7.5, 20, 60, 200]),
    np.array([2.5, 3.5, 4.5, 5.5, 7, 10, 20]),
    np.array([0.001, 0.03, 0.08, 0.15, 0.3, 0.6]),
    np.array([0.001, 0.05, 0.15, 0.3, 0.5]),
    np.array([0.001, 0.02, 0.1, 0.3, 0.6]),
]
_BINS = max(len(e) for e in _EDGES) + 1
_NONE = len(_EDGES) * _BINS


def _sums(data: bytes) -> np.ndarray:
    """Sums of each line of a block."""
    raw = np.frombuffer(data, dtype=np.uint8)
    breaks = np.flatnonzero(raw == 10)
    starts = np.append(0, breaks + 1)
    out = np.zeros((len(starts), _SUMS))
    if not len(raw):
        return out
    body = starts < len(raw)
    at = starts[body]
    for i, table in enumerate(_BYTE_SUMS):
        out[body, i] = np.add.reduceat(table[raw], at, dtype=np.int64)
    # The line break belongs to the line before it.
    out[: len(breaks), 0] -= 1
    out[: len(breaks), 1] -= 1
    word_at, hashes = word_hashes(data, NON_BLANK)
    if len(word_at):
        line = np.searchsorted(starts, word_at, side="right") - 1
        again = np.zeros(len(hashes), dtype=bool)
        for lag in (1, 2, 3):
            again[lag:] |= (hashes[lag:] == hashes[:-lag]) & (line[lag:] == line[:-lag])
        solid = np.add.reduceat(ALNUM[raw], word_at, dtype=np.int64)
        odd = np.add.reduceat(_ODD[raw], word_at, dtype=np.int64)
        n = len(starts)
        out[:, -4] = np.bincount(line, minlength=n)
        out[:, -3] = np.bincount(line, weights=again, minlength=n)
        out[:, -2] = np.bincount(line, weights=solid == 0, minlength=n)
        out[:, -1] = np.bincount(line, weights=odd > 0, minlength=n)
    return out


def _long_sums(text: bytes) -> np.ndarray:
    """The same for a text of any length, piece by piece; a cut line is added up."""
    parts = []
    for at in range(0, len(text), BLOCK):
        part = _sums(text[at : at + BLOCK])
        if parts:
            parts[-1][-1] += part[0]
            part = part[1:]
        parts.append(part)
    return np.concatenate(parts)


def _codes(sums: np.ndarray) -> np.ndarray:
    """Index of each feature's bin, one row per line."""
    size, chars, letters, capitals, ascii_, digits, odd, words, again, hollow, marked = sums.T
    over = lambda a, b: a / np.maximum(b, 1)
    values = [
        chars, over(letters, chars), over(capitals, ascii_), over(digits, chars), over(odd, chars),
        words, over(chars, words), over(again, words), over(hollow, words), over(marked, words),
    ]
    return np.stack([i * _BINS + np.searchsorted(e, v) for i, (e, v) in enumerate(zip(_EDGES, values))], axis=1)


@dataclass
class Lines:
    """Lines of neighbouring texts: feature codes, weights, and lines per text."""

    codes: np.ndarray
    weights: np.ndarray
    counts: np.ndarray


def read_lines(texts: Sequence[bytes | None]) -> Iterator[Lines]:
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= BLOCK):
            size += len(texts[end] or b"") + 1
            end += 1
        group = [t or b"" for t in texts[at:end]]
        sums = _long_sums(group[0]) if len(group) == 1 and size > BLOCK else _sums(b"\n".join(group))
        yield Lines(_codes(sums), sums[:, 1] + 1, np.array([t.count(b"\n") + 1 for t in group]))
        at = end


def _steps(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Line indices of the first line of every text, then of the second, and so on;
    longer texts first, so each array begins like the one before."""
    order = np.argsort(-counts, kind="stable")
    offsets = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    for t in range(int(lengths[0]) if len(lengths) else 0):
        yield offsets[: np.searchsorted(-lengths, -t, side="left")] + t


@dataclass
class Field:
    """Weights of the field; label 0 is bad, 1 is good."""

    own: np.ndarray = field(default_factory=lambda: np.zeros(_NONE + 1))
    before: np.ndarray = field(default_factory=lambda: np.zeros(_NONE + 1))
    after: np.ndarray = field(default_factory=lambda: np.zeros(_NONE + 1))
    turn: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    constant: float | None = None

    def neighbours(self, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
        first = np.cumsum(lines.counts) - lines.counts
        last = np.cumsum(lines.counts) - 1
        prev, next_ = np.roll(lines.codes, 1, axis=0), np.roll(lines.codes, -1, axis=0)
        prev[first] = _NONE
        next_[last] = _NONE
        return prev, next_

    def marginals(self, lines: Lines, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chance of good per line, expected label turns (by ``share`` of each line), and the neighbours' codes."""
        prev, next_ = self.neighbours(lines)
        good = self.own[lines.codes].sum(1) + self.before[prev].sum(1) + self.after[next_].sum(1)
        unary = np.stack([np.zeros(len(good)), good], axis=1)
        steps = list(_steps(lines.counts))
        ahead, back = unary.copy(), np.zeros_like(unary)
        for here, then in zip(steps, steps[1:]):
            come = ahead[here[: len(then)]]
            step = np.logaddexp(come[:, 0, None] + self.turn[0], come[:, 1, None] + self.turn[1]) + unary[then]
            ahead[then] = step - step.max(axis=1, keepdims=True)
        for here, then in zip(reversed(steps[:-1]), reversed(steps[1:])):
            come = back[then] + unary[then]
            step = np.logaddexp(come[:, 0, None] + self.turn[:, 0], come[:, 1, None] + self.turn[:, 1])
            back[here[: len(then)]] = step - step.max(axis=1, keepdims=True)
        both = ahead + back
        chance = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        turns = np.zeros((2, 2))
        for here, then in zip(steps, steps[1:]):
            joint = ahead[here[: len(then)]][:, :, None] + self.turn + (unary[then] + back[then])[:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            turns += (joint if share is None else joint * share[then][:, None, None]).sum(axis=0)
        return chance, turns, prev, next_

    def scores(self, lines: Lines) -> np.ndarray:
        first = np.cumsum(lines.counts) - lines.counts
        if self.constant is not None:
            return np.full(len(lines.counts), self.constant)
        chance = self.marginals(lines)[0]
        return np.add.reduceat(chance * lines.weights, first) / np.add.reduceat(lines.weights, first)


def fit_field(lines: Lines, labels: np.ndarray, rounds: int = 150, rate: float = 0.2, decay: float = 1e-4) -> Field:
    """Penalized likelihood by Adam; ``labels`` per text, 1 is good.

    A text counts as the square root of its number of lines, so that texts of few
    lines are not drowned out.
    """
    model = Field()
    if len(labels) == 0 or labels.min() == labels.max():
        model.constant = float(labels.mean()) if len(labels) else 1.0
        return model
    y = np.repeat(labels, lines.counts).astype(float)
    share = np.repeat(1 / np.sqrt(lines.counts), lines.counts)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        counts = lines.counts[labels == label]
        seen[label, label] = ((counts - 1) / np.sqrt(counts)).sum()
    n = share.sum()
    parts = [model.own, model.before, model.after, model.turn]
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    for step in range(1, rounds + 1):
        chance, turns, prev, next_ = model.marginals(lines, share)
        error = (chance - y) * share / n
        slopes = [
            np.bincount(c.ravel(), weights=np.repeat(error, c.shape[1]), minlength=_NONE + 1)
            for c in (lines.codes, prev, next_)
        ] + [(turns - seen) / n]
        for p, g, m, v in zip(parts, slopes, first, second):
            g = g + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of labelled texts, for the driver."""
    for batch in batches:
        at = 0
        for lines in read_lines(batch["_text"].to_pylist()):
            n = len(lines.counts)
            ends = np.append(0, np.cumsum(lines.counts))
            codes = pa.ListArray.from_arrays(
                pa.array(ends * lines.codes.shape[1], pa.int32()), pa.array(lines.codes.ravel().astype(np.int16))
            )
            yield pa.RecordBatch.from_arrays([batch["_label"].slice(at, n), codes], ["label", "codes"])
            at += n


def _score(weights, body):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(**weights.value)
        for batch in batches:
            found = [model.scores(lines) for lines in read_lines(batch[body].to_pylist())]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0))
            keep = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), scores], [*keep, "score"])

    return run


def labelled_sample(labels: DataFrame, label: str, use: Column, most: int, doc_id: str = "doc_id") -> DataFrame:
    """(_id, _label) of at most ``most`` labelled rows, by the hash of their id."""
    rows = labels.filter(use & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(most)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    max_documents: int = 5000,
) -> Field:
    """Fit on labelled rows for which ``use`` (over the labels) is true."""
    sample = labelled_sample(labels, label, use, max_documents, doc_id)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text")).join(
        F.broadcast(sample), "_id"
    )
    found = rows.select("_text", "_label").mapInArrow(_read, "label int, codes array<smallint>").toArrow()
    if found.num_rows == 0:
        return fit_field(Lines(np.zeros((0, 1)), np.zeros(0), np.zeros(0, dtype=np.int64)), np.zeros(0))
    lists = found["codes"].combine_chunks()
    width = len(_EDGES)
    counts = np.diff(lists.offsets.to_numpy()) // width
    codes = lists.flatten().to_numpy().astype(np.int64).reshape(-1, width)
    return fit_field(Lines(codes, np.ones(len(codes)), counts), found["label"].to_numpy())


def score(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """Add ``score``, 0 to 1; a column of that name is replaced."""
    kept = [c for c in docs.columns if c.lower() != "score"]
    body = free_name(docs, "_text")
    rows = docs.select(*kept, F.col(text).cast("binary").alias(body))
    schema = StructType([*(rows.schema[c] for c in kept), StructField("score", DoubleType())])
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(vars(model)), body), schema)
