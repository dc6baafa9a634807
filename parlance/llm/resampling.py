"""Target-distribution importance resampling with deduplicated segments, in DataFrame functions only.

Texts are cut into segments, their lines. Equal lines are one segment: its words are taken, its runs of words
hashed to buckets and counted once, however often it occurs. A bucket's count in the corpus is the sum over
segments of count times occurrences; a document's sum of gains is the sum over its lines of what their
segments gained. Runs that reach over the end of a line belong to no segment: they are taken from the
document's own row and are added on both sides.

Documents refer to segments by 128 bits of hash, so the texts are shuffled once, as segments, and the rest is
narrow. Copies of a line are counted in each task before that shuffle; the join of a line that a
large part of all documents hold is an equi-join of written tables, which Spark splits.

The draw without replacement is Gumbel top-k: a document's noise follows from its id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import ascii_lower, column, written
from parlance.operators.ranking import ordered_rank

# Letters and digits of ASCII after lower-casing, and all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LINE_END = "\n"
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once for each row, however often the body's own lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(items: Column, length: int) -> Column:
    """Where runs of ``length`` items begin, from 1."""
    return F.when(F.size(items) >= length, F.sequence(F.lit(1), F.size(items) - (length - 1))).otherwise(F.array().cast("array<int>"))


def _runs(words: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(length)), " "))


def _inner(line: Column, longest: int, buckets: int) -> Column:
    """Buckets of all runs inside one line."""
    features = _words(line)
    if longest > 1:
        features = _let(features, lambda words: F.flatten(F.array(words, *[
            _runs(words, _starts(words, k), k) for k in range(2, longest + 1)])))
    return F.transform(features, lambda f: _bucket(f, buckets))


def _crossing(lines: Column, longest: int, buckets: int) -> Column:
    """Buckets of the runs whose first and last word stand in different lines."""
    if longest == 1:
        return F.array().cast("array<int>")

    def over_ends(words: Column, places: Column, length: int) -> Column:
        far = F.filter(_starts(words, length), lambda i: F.element_at(places, i) != F.element_at(places, i + (length - 1)))
        return _runs(words, far, length)

    def of_words(by_line: Column) -> Column:
        places = F.flatten(F.transform(by_line, lambda words, at: F.array_repeat(at, F.size(words))))
        return _let(F.struct(F.flatten(by_line).alias("words"), places.alias("places")), lambda x: F.flatten(
            F.array(*[over_ends(x["words"], x["places"], k) for k in range(2, longest + 1)])))

    return F.transform(_let(F.transform(lines, _words), of_words), lambda f: _bucket(f, buckets))


def _lines(text: Column) -> Column:
    return F.split(ascii_lower(text), LINE_END, -1)


def _name(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(SEED), line).alias("h2"))


def segments(texts: DataFrame, text: Column, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """One row per distinct line that holds a word: h1, h2, occurrences, n_words and the buckets of its runs."""
    lines = texts.select(F.explode(_lines(text)).alias("line")).where(F.col("line").rlike(WORD))
    counted = lines.groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))
    found = counted.select("line", "occurrences", _inner(F.col("line"), longest, buckets).alias("buckets"))
    n_words = F.size("buckets") if longest == 1 else F.regexp_count("line", F.lit(WORD))
    return found.select(_name(F.col("line")).alias("name"), "occurrences", n_words.alias("n_words"), "buckets").select(
        "name.*", "occurrences", "n_words", "buckets")


def _crossings(texts: DataFrame, text: Column, longest: int, buckets: int) -> DataFrame:
    return texts.select(F.explode(_crossing(_lines(text), longest, buckets)).alias("bucket"), F.lit(1).cast("bigint").alias("n"))


def bucket_counts(found: DataFrame, crossings: DataFrame) -> DataFrame:
    """bucket, n: features of all texts, from the segments and what reaches over their ends. At most one row a bucket and task is shuffled."""
    inside = found.select(F.explode("buckets").alias("bucket"), F.col("occurrences").alias("n"))
    return inside.unionAll(crossings).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain of every bucket: thousandths of the log ratio of target to source, with one added to each count."""
    own, other = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    counts = own.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(own, "bucket", "left").join(other, "bucket", "left")
    counts = counts.select("bucket", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("s", "t")])
    totals = counts.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t"))).scalar()
    ratio = ((F.col("t") + 1) * (totals["s"] + buckets)).cast("double") / ((F.col("s") + 1) * (totals["t"] + buckets)).cast("double")
    return counts.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain"))


def _sum_of(places: Column, by_bucket: Column) -> Column:
    return F.aggregate(places, F.lit(0).cast("bigint"), lambda total, b: total + F.get(by_bucket, b))


def _noise(id_col: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """One row per input row: id, n_features, weight, score and rank (NULL if it is not drawn).

    Features are the runs of 1 to ``longest`` words. Of the rows with at least ``min_words`` words,
    floor(percent * rows / 100) are drawn: those of the highest score, ties to the smaller id, a NULL id first.
    A NULL, empty or wordless text has no features and weight 0. Texts of any length are taken whole; a line is
    one row of the shuffle, so a task needs memory for its longest line. Rows that repeat an id and a text have equal
    figures and are drawn one after the other. Other columns are not read. An empty table gives no
    rows; an empty target gives every bucket a count of zero.
    """
    text, other = column(text_col), column(target_col)
    found = written(segments(docs, text, longest, buckets), "segments")
    by_bucket = written(gains(
        bucket_counts(found, _crossings(docs, text, longest, buckets)),
        bucket_counts(segments(target, other, longest, buckets), _crossings(target, other, longest, buckets)), buckets), "gains")
    # One value of ``buckets`` numbers, whatever the corpus.
    lookup = by_bucket.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "gain"))), lambda e: e["gain"])).scalar()
    gained = found.withColumn("_gains", lookup).select(
        "h1", "h2", "n_words", F.size("buckets").alias("n_features"), _sum_of(F.col("buckets"), F.col("_gains")).alias("gain"))
    # Row numbers are written once, so they stay as they are.
    names = F.transform(F.filter(_lines(text), lambda line: line.rlike(WORD)), _name)
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("rid"), column(id_col).cast("bigint").alias("id"), names.alias("lines"),
        _crossing(_lines(text), longest, buckets).alias("crossing")), "rows")
    joined = rows.select("rid", "id", F.inline("lines")).join(written(gained, "gained"), ["h1", "h2"])
    own = rows.withColumn("_gains", lookup).select(
        "rid", "id", F.lit(0).alias("n_words"), F.size("crossing").alias("n_features"), _sum_of(F.col("crossing"), F.col("_gains")).alias("gain"))
    sums = joined.select(own.columns).unionAll(own).groupBy("rid", "id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_words", "n_features", "gain")])
    mean = F.when(F.col("n_features") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0))
    scored = written(sums.withColumn("weight", mean.cast("bigint")).withColumn("score", F.col("weight") + _noise(F.col("id"), seed)), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    place = F.col("place") + 1
    ranked = ordered_rank(able.select("rid", "id", "n_features", "weight", "score"), [("score", False), ("id", True), ("rid", True)], "place")
    result = ranked.withColumn("rank", F.when(place <= drawn, place)).unionByName(
        scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint")), allowMissingColumns=True)
    return result.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
