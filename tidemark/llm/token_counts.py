"""Token counts under a unigram vocabulary, with work shared along a trie.

A text is cut into pre-tokens: the mark ``▁`` and a run of non-blank bytes. The
tokens of a pre-token are its likeliest segmentation into vocabulary pieces
(fewest tokens where two are equally likely); a character in no piece costs one
token for each of its UTF-8 bytes.

Each task inserts the distinct pre-tokens it meets into a trie. A trie node holds
the best forward score of the prefix it spells and the tokens that takes, computed
once from the nodes above it, so pre-tokens with a common beginning share all the
work on it; the node where a pre-token ends holds its terminal count. The trie is
emptied when it reaches ``most_nodes``, which bounds memory and changes no result.
Texts are read once; nothing is shuffled.

Defined results: NULL, empty and blank texts have no words and no tokens; invalid
UTF-8 counts as replacement characters; repeated rows get equal counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .text import free_name

MARK = "▁"
_ABSENT = object()


def read_pieces(model_file: str) -> dict[str, float]:
    """Pieces of a sentencepiece file with Zipf log-probabilities by their rank.

    The file's merge ranks are no probabilities; a piece of rank r gets weight
    1 / (r + 1). Control, unknown and single-byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(ids))))
    return {model.id_to_piece(i): -math.log(r + 1) - total for r, i in enumerate(ids)}


class Trie:
    """Forward scores of the prefixes of all inserted pre-tokens."""

    def __init__(self, pieces: Mapping[str, float], most_nodes: int = 800_000, most_length: int = 64) -> None:
        self.pieces = pieces
        # Every ending of a piece, with its score if it is a piece itself.
        self.endings = {piece[i:]: pieces.get(piece[i:]) for piece in pieces for i in range(len(piece))}
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.most_nodes, self.most_length = most_nodes, most_length
        self.terminal: dict[bytes, tuple[int, float]] = {}
        self.clear()

    def clear(self) -> None:
        self.terminal.clear()
        #: Node and next character, as one number, to the node below.
        self.children: dict[int, int] = {}
        self.scores: list[float] = [0.0]
        self.tokens: list[int] = [0]

    def step(self, text: str, end: int, scores: list[float], tokens: list[int]) -> tuple[float, int]:
        """Score and tokens of the first ``end`` characters, given those of all shorter prefixes."""
        endings = self.endings
        best, count = -math.inf, 0
        for start in range(end - 1, -1, -1):
            p = endings.get(text[start:end], _ABSENT)
            if p is None:
                continue
            if p is _ABSENT:
                # No piece ends like this, so none that is longer does.
                break
            value = scores[start] + p
            if value >= best and (value > best or tokens[start] + 1 < count):
                best, count = value, tokens[start] + 1
        spelled = scores[end - 1] + self.unknown
        if spelled >= best:
            size = tokens[end - 1] + len(text[end - 1].encode("utf-8", "replace"))
            if spelled > best or size < count:
                best, count = spelled, size
        return best, count

    def insert(self, word: bytes) -> None:
        text = MARK + word.decode("utf-8", "replace")
        scores, tokens = [0.0], [0]
        if len(text) > self.most_length:
            # Too long to be shared: the same steps without nodes.
            for i in range(1, len(text) + 1):
                score, count = self.step(text, i, scores, tokens)
                scores.append(score)
                tokens.append(count)
        else:
            children, all_scores, all_tokens = self.children, self.scores, self.tokens
            node = 0
            for i, c in enumerate(text, 1):
                edge = node << 21 | ord(c)
                node = children.get(edge, 0)
                if not node:
                    node = children[edge] = len(all_scores)
                    score, count = self.step(text, i, scores, tokens)
                    all_scores.append(score)
                    all_tokens.append(count)
                else:
                    score, count = all_scores[node], all_tokens[node]
                scores.append(score)
                tokens.append(count)
        self.terminal[word] = (tokens[-1], scores[-1])

    def count(self, text: bytes | None) -> tuple[int, int, float]:
        """Words, tokens and log-likelihood of a text."""
        words = (text or b"").split()
        for word in set(words).difference(self.terminal):
            self.insert(word)
        found = [self.terminal[w] for w in words]
        result = len(words), sum(n for n, _ in found), math.fsum(s for _, s in found)
        if len(self.scores) > self.most_nodes or len(self.terminal) > self.most_nodes:
            self.clear()
        return result


def _count(pieces, body):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(pieces.value)
        for batch in batches:
            rows = np.array([trie.count(t) for t in batch[body].to_pylist()], dtype=object).reshape(-1, 3)
            keep = batch.schema.names[:-1]
            columns = [pa.array(rows[:, i].tolist(), t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *columns], [*keep, "n_words", "n_tokens", "log_p"])

    return run


def count_tokens(docs: DataFrame, pieces: Mapping[str, float], text: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_tokens`` and ``log_p``; columns of those names are replaced.

    ``pieces``: the vocabulary with log-probabilities; it goes to every task.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_tokens", "log_p")]
    body = free_name(docs, "_text")
    rows = docs.select(*kept, F.col(text).cast("binary").alias(body))
    added = [StructField("n_words", LongType()), StructField("n_tokens", LongType()), StructField("log_p", DoubleType())]
    schema = StructType([*(rows.schema[c] for c in kept), *added])
    return rows.mapInArrow(_count(docs.sparkSession.sparkContext.broadcast(dict(pieces)), body), schema)
