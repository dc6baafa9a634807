"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder) and returns a table that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import exact_dedup, language_id, mixing, packing, simhash_dedup
from parlance.llm.common import documents, fold, word_count, written


def identify_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is clear; dictionaries and margin are learned from the folds that are not held out.

    NULL and empty texts and those without a letter go; very long ones are read whole. Repeated rows stay or go together; of
    languages equally near the one learned from more documents is taken. An empty table stays empty, and a table without
    labels goes as a whole.
    """
    labelled = docs.where(fold(F.col("doc_id"), 4) != 2)
    learned, margin = language_id.learn(labelled, F.col("text"), F.col("lang"), F.col("doc_id"))
    return language_id.identify(docs, learned, margin=margin).where("NOT rejected").select("_row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id, a NULL id last; of rows that share text and id, one.

    NULL counts as empty, texts may have any length, an empty table stays empty.
    """
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id, a NULL id last; ties go to the text of the smallest hash.

    NULL, empty and wordless texts are near copies of each other; very long ones are read whole; rows that share id and text
    stay or go together; an empty table stays empty.
    """
    return simhash_dedup.drop_near_duplicates(docs, shingle=4, radius=4)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes it, twice at most.

    Sizes are words, so NULL and empty texts add nothing and come once. NULL is a source of its own; rows that repeat id and
    size are drawn alike; texts may have any length; an empty table stays empty.
    """
    mixed = mixing.mix(docs, word_count(F.col("text")))
    return mixed.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Training sequences: the pieces of every document, with their ids, the ids' checksum and their places.

    A NULL or empty text is its end id alone; a very long one is cut into pieces; repeated rows are packed each for
    itself; an empty table gives no pieces.
    """
    packed = packing.pack(docs, added=packing.ADDED)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "ids", "sequence_id", "offset")


STAGES = [
    ("language ID", identify_languages),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Compression, fingerprints and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "stage")
    return STAGES[-1][1](spark, docs, folder)
