"""Packing documents into sequences by the sum-of-squares rule.

Each task tokenizes its own documents. Their pieces are then dealt evenly over groups, so that a group holds the
same mix of lengths whatever the input's split: the number of groups follows from the size of the texts alone. In
a group, pieces are placed from long to short. A piece goes to the open sequence that leaves the smallest sum, over
all residual gaps, of the squared count of open sequences with that gap; a new sequence is opened only if the piece
fits nowhere. Both the dealing and the order in a group depend on the rows alone, so a task that is run again gives
the same sequences.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import column, sent

CAPACITY = 2048
# A group has about this many pieces and sequences at least; a last sequence that stays half empty is then one of many.
LOOKAHEAD = 1 << 14
SEQUENCES = 1 << 10
BYTES_OF_TOKEN = 4
# Long texts are tokenized in parts that end before a single space between two other characters;
# such a place always lies between two pre-tokens.
PART = 1 << 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
# White space as the tokenizer's pattern knows it; longer runs are taken apart from the pattern, which tries them again and again.
LONG_BLANK = 1 << 16
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The added token of byte_bpe_50k.json, which is not in the file of ranks.
ADDED = {"<|endoftext|>": 50256}
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
PLACE = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]


def load_tokenizer(path: str, added: dict[str, int] | None = None) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks; ``added`` tokens get their ids, the strings of others are ordinary text.

    The ids are those that ``tokenizers`` gives with the JSON file of the same vocabulary: as loaded if ``added`` holds
    the file's added tokens, with ``encode_special_tokens`` if not. This library is several times faster on words that
    are rarely repeated. Added tokens hold no white space.
    """
    if any(re.search(r"\s", token) for token in added or ()):
        raise ValueError("an added token holds white space")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added or {})


def encode(tokenizer: tiktoken.Encoding, text: str | None, part: int = PART, long_blank: int = LONG_BLANK) -> np.ndarray:
    """All ids of the text, without a limit on its length or on its runs of white space.

    A run of white space before another character is one pre-token without its last character, and before an added token
    or at the end of the text it is one as a whole. Long runs are encoded so, as single pre-tokens.
    """
    text, found, at = text or "", [], 0
    for run in re.finditer(f"[{_BLANK}]{{{long_blank},}}", text):
        found += _encoded(tokenizer, text[at : run.start()], part)
        at = run.end() if run.end() == len(text) or text.startswith(tuple(tokenizer.special_tokens_set), run.end()) else run.end() - 1
        if at > run.start():
            found.append(np.array(tokenizer._encode_single_piece(text[run.start() : at]), "<u4"))
    return np.concatenate([*found, *_encoded(tokenizer, text[at:], part)]).astype("<u4", copy=False)


def _encoded(tokenizer: tiktoken.Encoding, text: str, part: int) -> list[np.ndarray]:
    found, at = [], 0
    while len(text) - at > part and (cut := _CUT.search(text, at + part)):
        found.append(tokenizer.encode_to_numpy(text[at : cut.start()], allowed_special="all"))
        at = cut.start()
    return [*found, tokenizer.encode_to_numpy(text[at:], allowed_special="all")]


def pieces_of(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first of several may be shorter than a sequence."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


class OpenSequences:
    """Sequences that still have room, by their gap."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.count = np.zeros(capacity + 1, np.int64)
        self.ids: dict[int, list[int]] = {}

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece. A sequence that becomes full leaves the count."""
        gap, here = self.capacity, self.count[length : self.capacity]
        if here.any():
            # (n_gap - 1)^2 + (n_rest + 1)^2 against n_gap^2 + n_rest^2; a rest of 0 is not counted.
            grown = 2 * (self.count[: len(here)] - here) + 2
            grown[0] = 1 - 2 * here[0]
            gap = length + int(np.where(here > 0, grown, np.iinfo(np.int64).max).argmin())
            sequence = self.ids[gap].pop()
            self.count[gap] -= 1
        else:
            sequence, self.next_id = self.next_id, self.next_id + 1
        if rest := gap - length:
            self.count[rest] += 1
            self.ids.setdefault(rest, []).append(sequence)
        return sequence, self.capacity - gap


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None,
           id_col: str = "doc_id", text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece, without a shuffle: doc_id, piece, start, length, ids."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path, added)
        held: list[tuple] = []

        def cut() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], _NAMES)
            held.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(tokenizer, text.as_py()), np.array([end_id], "<u4"))
                for piece, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    held.append((doc_id, piece, start, length, ids[start : start + length].tobytes()))
                    if len(held) >= 1024:
                        yield cut()
        if held:
            yield cut()

    return sent(docs.select(column(id_col).cast("bigint"), column(text_col))).mapInArrow(run, PIECES)


def groups_for(docs: DataFrame, capacity: int = CAPACITY, text_col: str = "text", lookahead: int = LOOKAHEAD) -> int:
    """How many groups keep some ``lookahead`` pieces and ``SEQUENCES`` sequences each, by the bytes of the texts."""
    size = F.coalesce(F.octet_length(column(text_col)), F.lit(0)).cast("bigint")
    n, more, size = docs.select(size.alias("b")).agg(
        F.count(F.lit(1)), F.sum(F.expr(f"b div {BYTES_OF_TOKEN * capacity}")), F.sum("b")).first()
    tokens = n + (size or 0) // BYTES_OF_TOKEN
    return max(1, min((n + (more or 0)) // lookahead, tokens // (capacity * SEQUENCES)))


def place(cut: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """The rows of pieces with sequence_id and offset; dealt evenly over so many groups, each packed in one task."""
    rest = [column(c) for c in cut.columns if c != "length"]
    dealt = cut.repartition(groups).sortWithinPartitions(F.desc("length"), *rest)
    names = [*cut.columns, *(f.name for f in PLACE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = OpenSequences(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            found = [room.place(n) for n in batch.column("length").to_pylist()]
            added = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    return dealt.mapInArrow(run, T.StructType([*cut.schema.fields, *PLACE]))


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", lookahead: int = LOOKAHEAD, ids: Column | None = None,
         added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers; each document ends
    with ``end_id``. The strings of ``added`` tokens in a text become their ids, for example with ``ADDED`` as
    ``tokenizers`` does; by default they are ordinary text. Documents longer than a sequence are cut into full pieces after a first one that
    may be shorter. A NULL or empty text is the end id alone. Repeated rows are packed each for itself. A NULL
    id is kept; other columns are not read; an empty table gives no rows. Runs of white space may have any length. Sequence ids are unique
    across tasks. A column over ``ids`` may be given to go in their place, for example their crc32: the rows that are
    shuffled are then narrow. A task needs memory for its longest text and the numbers of its open sequences. The sizes of
    the texts are read once, at once, for the number of groups.
    """
    cut = pieces(docs, capacity, end_id, vocabulary, id_col, text_col, added)
    if ids is not None:
        cut = cut.select("doc_id", "piece", "start", "length", ids)
    return place(cut, groups_for(docs, capacity, text_col, lookahead), capacity)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
