"""Exact duplicates by two passes with a Bloom filter, in DataFrame functions only.

Pass one sets, for each text, a few bits in one block of the filter and keeps the bits that two
or more rows set. Pass two looks every row up: a row with a bit that only it has set is unique
and passes straight through; the other rows, those possibly repeated, are grouped by digest.

The filter is broadcast. Its size follows the number of rows up to ``max_blocks`` blocks of
4 KB (32 MB); beyond, more unique rows are taken for possibly repeated and are shuffled, and
the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import ascii_lower, column, packed, unpacked, written

BLOCK_BITS = 32768  # the size of Spark's bitmap_construct_agg
BITS_PER_TEXT = 2
MAX_BLOCKS = 8192


def digest(text: Column) -> Column:
    """SHA-256 of the text after lower-casing A-Z; NULL counts as empty. Equal digests are equal texts."""
    return F.unhex(F.sha2(ascii_lower(text), 256))


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(blocks))


def _bits(sha: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(BITS_PER_TEXT)]


def repeated_filter(digests: DataFrame, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The bits set by two or more rows, as one bitmap per block, and the number of blocks.

    Counts per bit are combined before the shuffle, so a text with many copies costs one row per task.
    """
    rows = digests.count()
    blocks = 1
    while blocks < max_blocks and blocks * BLOCK_BITS < 8 * rows:
        blocks *= 2
    base = _block(F.col("sha"), blocks) * BLOCK_BITS
    hits = digests.select(F.explode(F.array(*[base + b for b in _bits(F.col("sha"))])).alias("bit"))
    twice = hits.groupBy("bit").count().where("count > 1")
    bitmaps = twice.groupBy(F.expr(f"bit div {BLOCK_BITS}").alias("block")).agg(
        F.bitmap_construct_agg(F.col("bit") % BLOCK_BITS).alias("bitmap"))
    return written(bitmaps, "bloom"), blocks


def with_possibly_repeated(rows: DataFrame, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """Rows with ``sha`` plus ``possibly_repeated``; at most ``MAX_BLOCKS`` bitmaps of 4 KB are broadcast."""
    marked = rows.withColumn("block", _block(F.col("sha"), blocks)).join(F.broadcast(bitmaps), "block", "left")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.expr("1").bitwiseAND(F.call_function("shiftright", byte, (bit % 8).cast("int"))) == 1

    both = F.lit(True)
    for bit in _bits(F.col("sha")):
        both = both & is_set(bit)
    return marked.withColumn("possibly_repeated", F.coalesce(both, F.lit(False))).drop("block", "bitmap")


def _repeated_groups(digests: DataFrame, max_blocks: int) -> tuple[DataFrame, DataFrame, int]:
    bitmaps, blocks = repeated_filter(digests, max_blocks)
    candidates = with_possibly_repeated(digests, bitmaps, blocks).where("possibly_repeated")
    groups = candidates.groupBy("sha").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("rid", F.coalesce(F.col("id"), F.lit(-(2**63)))).alias("keep_rid"),
    ).where("group_size > 1")
    return written(groups, "groups"), bitmaps, blocks


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sha, rid) of every row; written once, so the row numbers stay as they are."""
    return written(docs.select(
        column(id_col).cast("bigint").alias("id"), digest(column(text_col)).alias("sha"),
        F.monotonically_increasing_id().alias("rid"),
    ), "digests")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (lower-case hex).

    Of equal texts the row with the largest id stays. NULL texts count as empty. A NULL id is
    smaller than any other and a group of NULL ids has a NULL keep_id. Of rows that share text
    and id exactly one is kept. Texts of any length are read whole; only their digests are shuffled. Other columns are
    not read; an empty table gives no rows. The id is an integer.
    """
    digests = _digests(docs, id_col, text_col)
    groups, bitmaps, blocks = _repeated_groups(digests, max_blocks)
    marked = with_possibly_repeated(digests, bitmaps, blocks)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    unique = marked.where("NOT possibly_repeated").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    # Groups hold only texts found twice; a written table, so Spark can split a hot group's join.
    grouped = marked.where("possibly_repeated").join(groups, "sha", "left").select(
        F.col("id").alias(id_col), F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"), sha)
    return unique.unionByName(grouped)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The input's rows and columns without repeated texts; the rules are those of ``mark_duplicates``, for texts of any length."""
    digests = _digests(docs, id_col, text_col)
    groups, bitmaps, blocks = _repeated_groups(digests, max_blocks)
    # The rows that go, by digest and id: together they spread a hot group over all tasks.
    known = F.coalesce(F.col("id"), F.lit(-(2**63)))
    gone = written(digests.join(groups, "sha").where("NOT id <=> keep_id").select("sha", known.alias("known")).distinct(), "gone")
    rows = packed(docs, id=column(id_col).cast("bigint"), sha=digest(column(text_col))).withColumn("known", known)
    marked = with_possibly_repeated(rows, bitmaps, blocks)
    unique = unpacked(marked.where("NOT possibly_repeated"))
    kept = (
        marked.where("possibly_repeated").join(gone, ["sha", "known"], "left_anti")
        .dropDuplicates(["sha", "known"])  # only rows that share id and text are left to choose from
    )
    return unique.unionByName(unpacked(kept))
