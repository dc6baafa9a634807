"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import BATCH_BYTES, ensure_checkpoint_dir, sent  # noqa: F401

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the cluster's shared folder and read it back.

    It cuts lineage as a checkpoint does, survives lost executors, and keeps a known size,
    so that Spark decides by that size whether a join may broadcast it. The folder is
    removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def packed(df: DataFrame, **computed: Column) -> DataFrame:
    """All columns as one struct beside the computed ones, so that no name of the input can clash."""
    return df.select(F.struct(*[column(c) for c in df.columns]).alias(ROW), *[c.alias(n) for n, c in computed.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def column(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character is kept."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; the fold of a null id is that of an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts
