"""Toxicity of texts, disguised spellings included.

A disguised word is the output of a noisy channel: someone chose a word, then wrote
digits or signs for letters, spaced letters out, or repeated them. Each suspicious
stretch of a text becomes a lattice of the letters it may stand for, and a Viterbi
search picks the likeliest reading under a character trigram model of the whole
corpus. The readings join the words of the text, and a logistic model scores the
words and word beginnings that labelled texts have shown to matter.

* The character model counts every trigram of every text, in an array of fixed
  size that tasks fill and Spark sums.
* The logistic model is fitted on at most ``max_documents`` labelled rows, those
  with the smallest hash of their id, and keeps at most ``max_features`` features.
* Scoring is one pass over whole texts without a shuffle. Decoding is linear in the
  length of a stretch.

Defined results: NULL counts as empty; texts without known features get the score of
the model's constant; repeated rows get equal scores; without labelled rows of both
kinds every score is the share of toxic labels, or 0 without any.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import settle
from .dense import counted
from .quality import labelled_sample
from .text import free_name
from .words import ALNUM, BLOCK, lowered, marked, mixed, slot_bits, word_parts, word_sums

# Signs that stand for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "¢": "c", "£": "l",
}
# The letters that the character model tells apart, after the blank.
LETTERS = string.ascii_lowercase + "àáâäåãæçèéêëìíîïñòóôöõøùúûüýßœ"
SYMBOLS = 64
_OTHER = SYMBOLS - 1
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
PREFIXES = (4, 5, 6)
#: Words of more bytes are hashed by powers of one number, so that all endings of a run are hashed in one pass.
LONG = 64
_POWER = 0x9E3779B97F4A7C15

_SEPARATORS = r"[ .\-_*·]"
_LETTER = r"[^\W\d_]"
_SPACED = re.compile(rf"(?<!\w){_LETTER}(?:{_SEPARATORS}{{1,2}}(?:{_LETTER}|[0-9@$!|+])(?!\w)){{2,}}")
_SWAPPED = re.compile(rf"[0-9@$!|+€¢£]{_LETTER}|{_LETTER}[0-9@$!|+€¢£]")
_DRAWN = re.compile(rf"({_LETTER})\1\1")
#: What may part words inside a stretch: signs that stand for no letter; also those that are mostly punctuation; all signs.
_PARTS = (re.compile(r"[^\w@$!|+€¢£]+|_+"), re.compile(r"[^\w@$€¢£]+|_+"), re.compile(r"[\W_]+"))
_EDGE = ".,;:?\"'()[]{}<>*&%#~^=/\\_-"


def _code_table() -> np.ndarray:
    table = np.full(1 << 16, _OTHER, dtype=np.int64)
    for c, i in _CODE.items():
        table[ord(c)] = i
        if len(c.upper()) == 1:
            table[ord(c.upper())] = i
    for c in range(1 << 12):
        if not chr(c).isalnum() and not 0x300 <= c < 0x370:
            table[c] = 0
    return table


def _count_trigrams(table: np.ndarray):
    def add(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for text in batch["_text"].to_pylist():
            for at in range(0, len(text or ""), BLOCK):
                # Two characters of the piece before, or blanks, come along.
                piece = (" " + text[: at + BLOCK] + " ") if at == 0 else text[at - 2 : at + BLOCK]
                code = np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32)
                c = table[np.minimum(code, len(table) - 1)]
                np.add.at(counts, (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], 1)

    return add


@dataclass
class CharacterModel:
    """Interpolated trigram log-probabilities ``log_p[a, b, c]`` of c after a, b."""

    log_p: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> CharacterModel:
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
        p3 = (three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)
        return cls(np.log(p3).astype(np.float32))


#: Log-chances of the channel: a letter as it is, a sign for a letter, a sign that is
#: no letter, a repeated letter written for one, a separator inside a word.
KEPT, SWAPPED, NOISE, DRAWN, SPLIT, BLANK = 0.0, -1.0, -7.0, -0.5, -0.1, -1.5


def lattice(stretch: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """For each place the letters it may stand for ('' for none) and their chances.

    ``apart``: separators may part words, as they always may in a spaced-out run.
    """
    steps: list[list[tuple[str, float]]] = []
    low = stretch.lower()
    spaced = bool(_SPACED.fullmatch(stretch))
    for i, c in enumerate(low):
        if c in LEET:
            readings = [(r, SWAPPED) for r in LEET[c]]
            # Beside a digit of the same kind the sign may be itself, or nothing at the edge.
            steps.append([*readings, ("", NOISE)])
        elif c.isalpha():
            again = i > 0 and low[i - 1] == c
            run = i > 1 and low[i - 2] == c
            # In a run of three or more a letter may be drawn out.
            long_run = again and (run or (i + 1 < len(low) and low[i + 1] == c))
            steps.append([(c, KEPT), ("", DRAWN)] if long_run else [(c, KEPT)])
        elif spaced or apart:
            steps.append([("", SPLIT), (" ", BLANK)])
        else:
            steps.append([("", SPLIT)])
    return steps


def decode(stretch: str, model: CharacterModel, apart: bool = False) -> str:
    """The likeliest reading: Viterbi over the last two letters of the output."""
    log_p = model.log_p
    # State: last two symbols; value: score and a linked list of output letters.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice(stretch, apart):
        nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in states.items():
            for letter, chance in options:
                if letter == "":
                    key, value, out = (a, b), score + chance, path
                else:
                    c = _CODE.get(letter, 0 if letter == " " else _OTHER)
                    key, value, out = (b, c), score + chance + float(log_p[a, b, c]), (letter, path)
                if key not in nxt or value > nxt[key][0]:
                    nxt[key] = (value, out)
        states = nxt
    best = max(
        ((score + float(log_p[a, b, 0]), path) for (a, b), (score, path) in states.items()), key=lambda s: s[0]
    )[1]
    letters = []
    while best:
        letters.append(best[0])
        best = best[1]
    return "".join(reversed(letters))


def stretches(text: str) -> Iterator[str]:
    """The parts of a text that may be disguised words."""
    seen = -1
    for pattern in (_SWAPPED, _DRAWN):
        seen = -1
        for hit in pattern.finditer(text):
            if hit.start() < seen:
                continue
            start, end = hit.start(), hit.end()
            while start > 0 and not text[start - 1].isspace():
                start -= 1
            while end < len(text) and not text[end].isspace():
                end += 1
            seen = end
            word = text[start:end].strip(_EDGE)
            body = word.rstrip("!+|$")
            yield word if len(word) - len(body) == 1 and word[-1] in "$!" and len(body) < 12 else body
    for hit in _SPACED.finditer(text):
        yield hit.group()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _tails(letters: np.ndarray) -> np.ndarray:
    """For each place the sum of the bytes from there on times rising powers."""
    n = len(letters)
    sums = np.cumsum((letters * _powers(_POWER, n))[::-1], dtype=np.uint64)[::-1]
    return sums * _powers(pow(_POWER, -1, 1 << 64), n)


def ending_features(word: str) -> np.ndarray:
    """The features of every ending of four letters or more, as if each were a word of
    the text. Linear in the word."""
    raw = np.frombuffer(word.encode("utf-8", "replace"), dtype=np.uint8)
    letters, n = lowered(raw), len(raw)
    starts = np.flatnonzero((raw & 0xC0) != 0x80)[: max(0, len(word) - 3)]
    far, near = starts[n - starts > LONG], starts[n - starts <= LONG]
    out = [mixed(mixed(_tails(letters)[far]) ^ np.uint64(1))]
    whole = np.array([word_sums(letters[None, i:])[0] for i in near], dtype=np.uint64)
    out.append(mixed(whole ^ np.uint64(1)))
    for k in PREFIXES:
        cells = starts[n - starts > k][:, None] + np.arange(k)
        out.append(mixed(word_sums(letters[cells]) ^ np.uint64(k)))
    return np.concatenate(out)


class Reader:
    """Readings of stretches, remembered within a task."""

    def __init__(self, model: CharacterModel, most: int = 100_000) -> None:
        self.model, self.most, self.known = model, most, {}

    def words(self, text: str) -> list[str]:
        return self.read(text)[0]

    def read(self, text: str) -> tuple[list[str], list[np.ndarray]]:
        """The words of all readings, and the features of the endings of spaced-out runs."""
        out, endings = [], []
        for stretch in stretches(text):
            if not stretch:
                continue
            if stretch not in self.known:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[stretch] = self._read(stretch)
            words, features = self.known[stretch]
            out.extend(words)
            if features is not None:
                endings.append(features)
        return out, endings

    def _read(self, stretch: str) -> tuple[list[str], np.ndarray | None]:
        read = decode(stretch, self.model)
        words = read.split()
        if not _SPACED.fullmatch(stretch):
            return [*words, *self._apart(stretch)], None
        # Where the word starts is unsure, so every ending of the run is a word too.
        joined = read.replace(" ", "")
        return [*words, joined], ending_features(joined)


    def _apart(self, stretch: str) -> list[str]:
        """Further words if the signs inside part words instead of hiding one."""
        words, seen = [], {stretch}
        if _PARTS[0].search(stretch):
            words += decode(stretch, self.model, apart=True).split()
        for sign in _PARTS:
            for part in sign.split(stretch):
                if part not in seen and (_SWAPPED.search(part) or _DRAWN.search(part)):
                    seen.add(part)
                    words += decode(part, self.model).split()
        return words


def features(texts: Sequence[str | None], reader: Reader) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of (first text, feature hashes, text of each feature).

    Features are the words and their first 4, 5 and 6 bytes where they are longer.
    """
    at = 0
    while at < len(texts):
        size, end, group, owners, hashes = 0, at, [], [], []
        while end < len(texts) and (end == at or size < BLOCK):
            text = texts[end] or ""
            words, endings = reader.read(text)
            group.append((text + "\n" + " ".join(words)).encode("utf-8", "replace"))
            owners += [np.full(len(e), end - at) for e in endings]
            hashes += endings
            size += len(group[-1]) + 1
            end += 1
        data = b"\n".join(group)
        limits = np.cumsum([len(g) + 1 for g in group])
        for offset, piece in _cut(data):
            starts, whole, (*parts, (long, _)) = word_parts(piece, ALNUM, (*PREFIXES, LONG))
            if len(long):
                raw = np.frombuffer(piece, dtype=np.uint8)
                ends = np.flatnonzero(ALNUM[raw] & ~np.append(ALNUM[raw[1:]], False)) + 1
                whole[long] = mixed(np.array([_tails(lowered(raw[starts[i] : ends[i]]))[0] for i in long], dtype=np.uint64))
            owner = np.searchsorted(limits, starts + offset, side="right")
            owners.append(owner)
            hashes.append(mixed(whole ^ np.uint64(1)))
            for n, (which, part) in zip(PREFIXES, parts):
                owners.append(owner[which])
                hashes.append(mixed(part ^ np.uint64(n)))
        yield at, np.concatenate(hashes), np.concatenate(owners)
        at = end


def _cut(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of about ``BLOCK`` bytes that end between words."""
    raw = np.frombuffer(data, dtype=np.uint8)
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and ALNUM[raw[end]]:
            end += 1
        yield at, data[at:end]
        at = end


@dataclass
class ToxicityModel:
    features: np.ndarray
    weights: np.ndarray
    constant: float
    log_p: np.ndarray


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, size: int, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on presence of features, by gradient steps with momentum."""
    weights, constant = np.zeros(size), 0.0
    if len(labels) == 0 or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return weights, float(np.log(share / (1 - share)))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate(rows).astype(np.int64)
    speed, pull = np.zeros(size + 1), 0.9
    # Both kinds count alike.
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    scale = balance.sum()
    for _ in range(rounds):
        z = constant + np.bincount(owner, weights=weights[index], minlength=len(rows))
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / scale
        slope = np.bincount(index, weights=error[owner], minlength=size) + 1e-5 * weights
        speed = pull * speed - 2.0 * np.append(slope, error.sum())
        weights = weights + speed[:-1]
        constant = constant + float(speed[-1])
    return weights, constant


def _emit(arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays.values()], list(arrays))


def _toxic_features(log_p):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharacterModel(log_p.value))
        for batch in batches:
            for _, hashes, owner in features(batch["_text"].to_pylist(), reader):
                order = np.lexsort((hashes, owner))
                h, o = hashes[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                f, n = np.unique(h[new], return_counts=True)
                yield _emit({"f": f.view(np.int64), "n": n.astype(np.int64)})

    return run


def _counted_features(log_p, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharacterModel(log_p.value))
        for batch in batches:
            for _, hashes, owner in features(batch["_text"].to_pylist(), reader):
                keep = marked(hashes, bits.value)
                pairs = np.unique(np.stack([owner[keep].astype(np.uint64), hashes[keep]], axis=1), axis=0)
                f, n = np.unique(pairs[:, 1], return_counts=True)
                yield _emit({"f": f.view(np.int64), "n": n.astype(np.int64)})

    return run


def _lookup(known: np.ndarray, hashes: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """Indices of the known features of each text."""
    at = np.searchsorted(known, hashes)
    at[at == len(known)] = 0
    hit = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
    pairs = np.unique(owner[hit].astype(np.int64) * max(1, len(known)) + at[hit])
    which, index = np.divmod(pairs, max(1, len(known)))
    return np.split(index, np.searchsorted(which, np.arange(1, n)))


def _rows(known, log_p):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharacterModel(log_p.value))
        for batch in batches:
            texts = batch["_text"].to_pylist()
            out: list[np.ndarray] = []
            for at, hashes, owner in features(texts, reader):
                n = min(len(texts), at + (int(owner.max()) + 1 if len(owner) else 1)) - at
                out += [np.zeros(0, dtype=np.int64)] * (at - len(out)) + _lookup(known.value, hashes, owner, n)
            out += [np.zeros(0, dtype=np.int64)] * (len(texts) - len(out))
            yield pa.RecordBatch.from_arrays([batch["_label"], pa.array(out, pa.list_(pa.int64()))], ["label", "index"])

    return run


def _score(parts, log_p, body):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, constant = parts.value
        reader = Reader(CharacterModel(log_p.value))
        for batch in batches:
            texts = batch[body].to_pylist()
            z = np.full(len(texts), constant)
            for at, hashes, owner in features(texts, reader):
                n = int(owner.max()) + 1 if len(owner) else 0
                for i, index in enumerate(_lookup(known, hashes, owner, n) if n else []):
                    z[at + i] += weights[index].sum()
            scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            keep = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(scores)], [*keep, "score"])

    return run


def character_model(docs: DataFrame, text: str = "text") -> CharacterModel:
    """Trigram model of all texts of the corpus."""
    frame = docs.select(F.col(text).alias("_text"))
    return CharacterModel.from_counts(counted(frame, SYMBOLS**3, _count_trigrams(_code_table())))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    max_documents: int = 20_000,
    max_features: int = 50_000,
    min_documents: int = 5,
    min_share: float = 0.005,
    min_ratio: float = 10.0,
) -> ToxicityModel:
    """Fit on labelled rows for which ``use`` (over the labels) is true.

    A feature is kept if ``min_documents`` toxic texts and ``min_share`` of them hold
    it, and its share among them is ``min_ratio`` times that among the others.
    """
    spark = docs.sparkSession
    log_p = character_model(docs, text).log_p
    shared = spark.sparkContext.broadcast(log_p)
    chosen = labelled_sample(labels, label, use, max_documents, doc_id)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = settle(rows.select("_text", "_label"), "labelled")
    toxic = rows.filter("_label = 1").select("_text").mapInArrow(_toxic_features(shared), "f long, n long")
    sizes = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    least = max(min_documents, min_share * n_toxic)
    toxic = settle(toxic.groupBy("f").agg(F.sum("n").alias("toxic")).filter(F.col("toxic") >= least), "toxic")
    bits = spark.sparkContext.broadcast(slot_bits(toxic, "f"))
    others = rows.filter("_label = 0").select("_text").mapInArrow(_counted_features(shared, bits), "f long, n long")
    others = others.groupBy("f").agg(F.sum("n").alias("other"))
    gain = F.col("toxic") / n_toxic / ((F.coalesce("other", F.lit(0)) + 0.5) / n_other)
    kept = toxic.join(others, "f", "left").withColumn("gain", gain).filter(F.col("gain") >= min_ratio)
    kept = kept.orderBy((F.col("toxic") * F.log("gain")).desc(), "f").limit(max_features).select("f").toArrow()
    known = np.sort(kept["f"].to_numpy().astype(np.int64).view(np.uint64))
    found = rows.mapInArrow(_rows(spark.sparkContext.broadcast(known), shared), "label int, index array<long>").toArrow()
    index = [np.asarray(r.values if hasattr(r, "values") else r, dtype=np.int64) for r in found["index"]]
    weights, constant = fit_weights(index, found["label"].to_numpy(), len(known))
    return ToxicityModel(known, weights, constant, log_p)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score``, 0 to 1; a column of that name is replaced."""
    kept = [c for c in docs.columns if c.lower() != "score"]
    body = free_name(docs, "_text")
    rows = docs.select(*kept, F.col(text).alias(body))
    schema = StructType([*(rows.schema[c] for c in kept), StructField("score", DoubleType())])
    context = docs.sparkSession.sparkContext
    parts = context.broadcast((model.features, model.weights, model.constant))
    return rows.mapInArrow(_score(parts, context.broadcast(model.log_p), body), schema)
