"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens.

The best segmentation of a prefix does not depend on what follows it. So each trie node keeps the forward
score of the prefix that it stands for, and its number of tokens, and is computed once for all
pre-tokens that begin with it. The count at the end of a pre-token is stored; a text's count is the
sum over its pre-tokens.

The vocabulary is a public one and is not trained. Its file gives ranks, not probabilities, so pieces get those
of Zipf's law: merged pieces in the order of the file, then the single bytes, which make every text
countable.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from parlance.llm.common import column, sent

MAX_NODES = 1 << 18
MAX_DEPTH = 256
MAX_KEPT = 1 << 24  # characters of the pre-tokens whose counts a task keeps


def zipf_scores(path: str) -> dict[bytes, float]:
    """Piece to log probability, from a file of base64 pieces and ranks."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in (line.split() for line in lines))
    pieces = [p for _, p in ranked if len(p) > 1] + [p for _, p in ranked if len(p) == 1]
    total = math.fsum(1 / r for r in range(1, len(pieces) + 1))
    return {p: -math.log(r * total) for r, p in enumerate(pieces, 1)}


class ForwardTrie:
    """Pre-tokens inserted so far, with the forward score and token count of every prefix."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.max_nodes = max_nodes
        # Pieces by their bytes from last to first; 256 marks the end of a piece.
        self.backward: dict = {}
        for piece, score in scores.items():
            at = self.backward
            for byte in reversed(piece):
                at = at.setdefault(byte, {})
            at[256] = score
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}
        self.kept = 0

    def _forward(self, word: bytes, depth: int, score: list[float], tokens: list[int]) -> tuple[float, int]:
        """The best last piece of word[:depth], given the scores of all shorter prefixes; ties take fewer tokens."""
        at, best, count = self.backward, -math.inf, 0
        for start in range(depth - 1, -1, -1):
            at = at.get(word[start])
            if at is None:
                break
            piece = at.get(256)
            if piece is not None:
                total, n = score[start] + piece, tokens[start] + 1
                if total > best or total == best and n < count:
                    best, count = total, n
        return best, count

    def insert(self, word: bytes) -> int:
        """Tokens of the word. Prefixes already in the trie are not computed again."""
        node, score, tokens = 0, [0.0], [0]
        shared = len(word) <= MAX_DEPTH  # longer ones are computed alone, so that the trie stays small
        for depth, byte in enumerate(word, 1):
            nxt = self.child.get(node << 8 | byte) if shared else None
            if nxt is None:
                best, count = self._forward(word, depth, score, tokens)
                if shared:
                    nxt = self.child[node << 8 | byte] = len(self.score)
                    self.score.append(best)
                    self.tokens.append(count)
            else:
                best, count = self.score[nxt], self.tokens[nxt]
            if shared:
                node = nxt
            score.append(best)
            tokens.append(count)
        return tokens[-1]

    def count_all(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each text, given its pre-tokens. A full trie is emptied; counts do not depend on it.

        What is kept is bounded by its nodes and by the characters of its terminals; pre-tokens that are too long to
        share prefixes are counted for these texts only.
        """
        if len(self.score) > self.max_nodes or self.kept > MAX_KEPT:
            self.clear()
        known, once = self.terminal, {}
        for word in sorted(set().union(*texts).difference(known) if texts else ()):
            encoded = word.encode()
            if len(encoded) <= MAX_DEPTH:
                known[word] = self.insert(encoded)
                self.kept += len(word)
            else:
                once[word] = self.insert(encoded)
        if once:
            return [sum(once[w] if w in once else known[w] for w in words) for words in texts]
        return [sum(map(known.__getitem__, words)) for words in texts]


def token_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """One row per input row: id, n_bytes, n_pretokens, n_tokens.

    Texts are counted whole, whatever their length. A NULL or empty text has zeros. Repeated rows are counted each for itself;
    a NULL id is kept; other columns are not read; an empty table gives no rows. No row is shuffled, and a task's
    trie is emptied once it has more than ``max_nodes`` nodes or ``MAX_KEPT`` characters of pre-tokens.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, split = ForwardTrie(zipf_scores(path), max_nodes), regex.compile(public_tokenizers.PATTERN).findall
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                words = [split(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([len(w) for w in words], pa.int64()), pa.array(trie.count_all(words), pa.int64()),
                ], ["doc_id", "n_bytes", "n_pretokens", "n_tokens"])

    counted = sent(docs.select(column(id_col).cast("bigint"), column(text_col))).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_pretokens bigint, n_tokens bigint")
    return counted.withColumnRenamed("doc_id", id_col)
