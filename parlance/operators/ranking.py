"""Exact ranks, cut-offs and order statistics without a single-task sort.

Two devices are used here; order statistics and cut-offs are found by refining histograms (``selection``).

* *Hash order.* A row key is hashed; the leading hex digits are a bucket number, so
  bucket order is hash order. Counts per bucket (at most 65,536 rows whatever the
  table size) give each bucket's offset, and only rows of one bucket ever meet.
* *A given order.* Rows are range-partitioned on a unique composite key, so that ties
  spread over partitions, and each partition is numbered locally. The sorted keys are
  checkpointed once, because range bounds are sampled and a re-run stage may choose others.

Hash order assumes that ``key`` is unique; rows that share a key stay together.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parlance.functions.hashing import digest, hash_bucket, uniform
from parlance.operators import selection
from parlance.operators.joins import same_keys
from parlance.session import ensure_checkpoint_dir, freeze

Order = list[tuple[str, bool]]  # (column, ascending)

LARGEST = 1 << 20  # rows of a group that one window numbers
FEW = 4096  # a cut-off of at most so many rows is found from the first rows of every task
HEX_DIGITS = 4  # 65,536 buckets: offsets stay below a few MB, a bucket is 1/65,536 of the rows
_POSITION_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in 33 bits


def _running_offsets(counts: DataFrame, order: str, n: str) -> DataFrame:
    """Rows before each bucket. The input has one row per bucket, so one task is enough."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum(n).over(before), F.lit(0)).cast("bigint"))


def hash_rank(df: DataFrame, key: str, seed: int = 42, name: str = "rank",
              keys: DataFrame | None = None) -> DataFrame:
    """Add the exact 0-based global position in seeded hash order (a reproducible shuffle).

    The bucket counts need a pass of their own. If ``df`` is expensive to compute, pass as
    ``keys`` a table that holds exactly the same keys and is cheap to scan; a bucket whose
    rows differ in number from its count stops the job.
    """
    h = digest(seed, F.col(key))
    hashed = df.withColumn("_h", h).withColumn("_b", hash_bucket(F.col("_h"), HEX_DIGITS))
    counted = (df if keys is None else keys).select(hash_bucket(h, HEX_DIGITS).alias("_b"))
    offsets = _running_offsets(counted.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")), "_b", "_n")
    bucket = Window.partitionBy("_b")
    placed = (
        hashed.withColumn("_i", F.row_number().over(bucket.orderBy("_h", key)) - 1)
        .withColumn("_rows", F.lit(None) if keys is None else F.count(F.lit(1)).over(bucket))
        .join(F.broadcast(offsets), "_b", "left")  # at most 65,536 rows
    )
    rank = F.col("offset") + F.col("_i")
    if keys is not None:
        same = F.col("_rows") == F.col("_n")
        rank = F.when(same, rank).otherwise(F.raise_error(F.lit("keys holds other rows than the table")))
    return placed.withColumn(name, rank).select(*df.columns, name)


def split_size(total: Column, ratio: float) -> Column:
    """Rows in the first part: the fractional size cut off, as integer conversion does."""
    return F.floor(total * F.lit(float(ratio))).cast("bigint")


def hash_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42, name: str = "split",
               frozen: bool = False) -> DataFrame:
    """Label exactly ``int(n * ratio)`` rows 'train' and the rest 'val', in seeded hash order.

    No row is shuffled: bucket counts locate the one bucket in which the cut falls,
    the cut-off key is found inside it, and labelling is a comparison with that key.
    The cut is looked for in every job that uses the labels, or once if it is ``frozen``.
    """
    h = digest(seed, F.col(key))
    counts = (
        df.select(hash_bucket(h, HEX_DIGITS).alias("_b")).groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    )
    whole = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = (
        _running_offsets(counts, "_b", "_n")
        .withColumn("_k", split_size(F.sum("_n").over(whole), ratio))
        .where((F.col("offset") < F.col("_k")) & (F.col("_k") <= F.col("offset") + F.col("_n")))
        .select(F.col("_b"), (F.col("_k") - F.col("offset")).alias("_need"))
    )
    # the keys of one bucket: about 1/65,536 of the table, one row per distinct key
    inside = (
        df.select(h.alias("_h"), F.col(key).alias("_key"), hash_bucket(h, HEX_DIGITS).alias("_b"))
        .join(F.broadcast(cut), "_b")
        .groupBy("_h", "_key", "_need").agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_sum", F.sum("_c").over(Window.orderBy("_h", "_key")))
        .where(F.col("_sum") <= F.col("_need"))
    )
    # the cut bucket may hold no complete key group; then everything before it is 'train'
    last = inside.agg(F.max(F.struct("_h", "_key")).alias("last"))
    found = cut.agg(F.max("_b").alias("edge")).withColumn("last", last.scalar())  # one row
    if frozen:
        found = freeze(found)
    at = found.select(F.struct("edge", "last")).scalar()
    cutoff = F.coalesce(F.struct(h.alias("_h"), F.col(key).alias("_key")) <= at["last"], F.lit(False))
    before = F.coalesce(hash_bucket(h, HEX_DIGITS) < at["edge"], F.lit(False))
    return df.withColumn(name, F.when(before | cutoff, F.lit("train")).otherwise(F.lit("val")))


def threshold_split(key: Column, ratio: float = 0.8, seed: int = 42) -> Column:
    """Label by an independent coin per row: approximate sizes, no pass over the table at all."""
    return F.when(uniform(seed, "split", key) < F.lit(ratio), F.lit("train")).otherwise(F.lit("val"))


def sorted_chunks(df: DataFrame, order: list[Column], keep: list[Column | str]) -> DataFrame:
    """Sorted rows with ``_pid`` (partition, in order) and ``_pos`` (position inside it).

    ``order`` must be unique per row for partitions to be balanced. Only ``keep`` is written.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            *keep,
            F.spark_partition_id().alias("_pid"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
        )
        .checkpoint()
    )


def _sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c, ascending in order]


def ordered_rank(df: DataFrame, order: Order, name: str = "rank") -> DataFrame:
    """Add the exact 0-based global position in a given (unique) order.

    The sorted rows are written once: pass only the columns that are needed.
    """
    chunks = sorted_chunks(df, _sort_columns(order), list(df.columns))
    counts = chunks.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _running_offsets(counts, "_pid", "_n").select("_pid", "offset")
    return (
        chunks.join(F.broadcast(offsets), "_pid")  # one row per partition
        .withColumn(name, F.col("offset") + F.col("_pos"))
        .select(*df.columns, name)
    )


def among_first(df: DataFrame, order: Order, size: int | Callable[[int], int]) -> Column:
    """Whether a row of ``df`` is among the first ``size`` (or ``size(row count)``) of a given (unique) order; missing values come last.

    The cut-off row is found first: for a small fixed size in one pass, by what each task holds best, else by
    refining histograms over the order columns, written once. Every row is then compared with it where it is:
    nothing is sorted or shuffled.
    """
    if isinstance(size, int) and size <= FEW:
        return _among_few(df, order, size)
    last = selection.cut_off(df, order, size if callable(size) else lambda total: size)
    return selection.inside(df, order, last)


def _among_few(df: DataFrame, order: Order, size: int) -> Column:
    """The same for a bounded size: each task keeps its first ``size`` keys, and the last of all is the cut-off."""
    keys = df.select(*[selection.ordinal(df, c).alias(f"o{i}") for i, (c, _) in enumerate(order)])
    names = keys.columns
    sort = [F.asc_nulls_last(o) if ascending else F.desc_nulls_last(o) for o, (_, ascending) in zip(names, order)]
    rank = F.row_number().over(Window.orderBy(*sort))  # over at most ``size`` rows
    first = keys.orderBy(*sort).limit(size).withColumn("_rank", rank)
    last = first.agg(F.max(F.struct("_rank", *names)).alias("last")).select("last").scalar()
    within = F.lit(True)
    for o, (c, ascending) in reversed(list(zip(names, order))):
        x, cut = selection.ordinal(df, c), last[o]
        before = F.when(cut.isNull(), x.isNotNull()).otherwise(F.coalesce(x < cut if ascending else x > cut, F.lit(False)))
        within = before | (x.eqNullSafe(cut) & within)
    return last.isNotNull() & within


def ordered_split(df: DataFrame, order: Order, ratio: float = 0.8, name: str = "split") -> DataFrame:
    """Label the first ``int(n * ratio)`` rows of a given (unique) order 'train', the rest 'val'."""
    first = among_first(df, order, lambda total: int(total * float(ratio)))
    return df.withColumn(name, F.when(first, F.lit("train")).otherwise(F.lit("val")))


def number_turns(df: DataFrame, group: str, order: list[str], name: str = "turn", largest: int = LARGEST) -> DataFrame:
    """0-based position of each row within its group, a bigint; NULL is a group, and missing values come first.

    Groups are counted first. If none has more than ``largest`` rows, one window per group numbers them, else a
    group that is a third of the table is cut by range partitions on its order columns. Of these keys alone is
    sorted and written; rows then get their number by key, and rows that share a key follow each other.
    """
    most = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if most <= largest:
        place = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("bigint") - 1
        return df.withColumn(name, place)
    keys = [group, *order]
    distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    chunks = sorted_chunks(distinct, [F.col(c) for c in keys], [*keys, "_n"])
    upto = Window.partitionBy("_pid", group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    pieces = chunks.groupBy("_pid", group).agg(F.sum("_n").alias("_rows"))
    # every partition the group crosses gives one row here: at most one per partition
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_carry", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    first = same_keys(placed, pieces, ["_pid", group]).select(*keys, (F.col("_before") + F.col("_carry")).alias("_first"))
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy("_first")) - 1
    return same_keys(df, first, keys).withColumn(name, (F.col("_first") + copy).cast("bigint")).select(*df.columns, name)


def median_type(kind: T.DataType) -> T.DataType:
    """The type that holds a median exactly: a double, or a decimal with one more digit for 64-bit integers and decimals."""
    if isinstance(kind, T.LongType):
        return T.DecimalType(20, 1)
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(kind.precision + 1, kind.scale + 1) if kind.precision < 38 else kind
    return T.DoubleType()


def median_of(df: DataFrame, column: str) -> DataFrame:
    """One-row exact median of a numeric column (the mean of the middle two), NULL for an empty column."""
    value = selection.medians(df, [column])[column]
    return df.sparkSession.range(1).select(as_literal(value, median_type(df.schema[column].dataType)).alias("median"))


def as_literal(value: float | Decimal | None, kind: T.DataType) -> Column:
    """A number as a column of a type; a decimal is rounded half up to the type's scale."""
    if isinstance(value, Decimal):
        digits = Decimal(1).scaleb(-kind.scale) if isinstance(kind, T.DecimalType) else None
        value = float(value) if digits is None else value.quantize(digits, ROUND_HALF_UP, selection.EXACT)
    return F.lit(value).cast(kind)
