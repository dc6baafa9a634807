"""From raw texts to training examples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.batching import next_token_pairs
from parlance.operators.ranking import hash_split
from parlance.operators.vocabulary import MAX_LENGTH, VOCAB_SIZE, build_vocab, encode
from parlance.session import freeze


@dataclass(frozen=True)
class Prepared:
    vocab: DataFrame
    examples: DataFrame  # key, split, input_ids, target_ids


def prepare_texts(df: DataFrame, key: str, text: str, ratio: float = 0.8, seed: int = 42,
                  vocab_size: int = VOCAB_SIZE, max_length: int | None = MAX_LENGTH) -> Prepared:
    """Split, build the vocabulary on the training part only, encode both parts, shift by one."""
    labelled = hash_split(df.where(F.col(text).isNotNull()), key, ratio, seed, frozen=True)
    # a full pass over the texts, used by every later encoding: done once
    vocab = freeze(build_vocab(labelled.where(F.col("split") == "train"), text, vocab_size))
    encoded = encode(labelled, key, text, vocab, max_length, keep=("split",))
    return Prepared(vocab, next_token_pairs(encoded))
