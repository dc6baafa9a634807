"""Quality rules: measures of each text, and line frequency across documents; DataFrame functions only.

Lines are normalised and hashed together with their host. A line in more than ``max_documents``
documents of its host is boilerplate and is removed; a document that keeps too small a share of its
words is depleted and rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import ascii_lower, column, written

BLANK = " \t\n\x0b\x0c\r"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCUMENTS = 20
MIN_SHARE_LEFT = 0.3
WINDOW = 3


def line_hash(host: Column, line: Column) -> Column:
    """Hash of host and normalised line: A-Z in lower case, each run of digits as one 0, no blanks around."""
    plain = F.regexp_replace(ascii_lower(line), "[0-9]+", "0")
    return F.xxhash64(host, F.btrim(plain, F.lit(BLANK)))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document with its measures and its lines as (h, w): hash and number of words."""
    host = column(host_col).cast("string")
    rows = docs.select(
        column(id_col).alias("doc_id"), host.alias("host"), F.coalesce(column(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("rid"))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda l: F.btrim(l, F.lit(BLANK)) != ""))
    rows = rows.withColumn("line_words", F.transform("lines", lambda l: F.split(F.btrim(l, F.lit(BLANK)), BLANKS)))
    rows = rows.withColumn("words", F.flatten("line_words"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("windows", windows)
    # Most texts repeat no window; only the others are sorted by (hash, place).
    has_twins = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(has_twins, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("ordered", ordered)
    at = F.col("ordered")
    twins = F.filter(at, lambda x, i: (F.get(at, i - 1)["h"] == x["h"]) | F.coalesce(F.get(at, i + 1)["h"] == x["h"], F.lit(False)))
    marks = F.flatten(F.transform(twins, lambda x: F.array(*[x["i"] + k for k in range(WINDOW)])))
    return rows.select(
        "rid", "doc_id", n.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.size(F.array_distinct(marks)), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.transform("lines", lambda l, i: F.struct(
            line_hash(F.col("host"), l).alias("h"), F.size(F.get(F.col("line_words"), i)).alias("w"))).alias("lines"),
    )


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                max_documents: int = MAX_DOCUMENTS, min_share_left: float = MIN_SHARE_LEFT) -> DataFrame:
    """One row per input row: id, the measures, n_removed_words, base_failed and kept.

    A NULL or empty text has no words and fails the base rules. A NULL host is a host of its own. Every
    row counts as a document, repeated rows too. A line counts once for each document. Other columns are
    not read; an empty table gives no rows.
    """
    facts = written(measured(docs, id_col, text_col, host_col), "measures")
    frequent = written(
        facts.select(F.explode(F.array_distinct("lines.h")).alias("h")).groupBy("h").count()
        .where(F.col("count") > max_documents).select("h"), "frequent")
    removed = facts.select("rid", F.inline("lines")).join(frequent, "h").groupBy("rid").agg(F.sum("w").alias("removed"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    left = F.col("n_words") - F.col("n_removed_words")
    return facts.drop("lines").join(removed, "rid", "left").select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed_words"), base_failed.alias("base_failed"),
    ).withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * F.lit(float(min_share_left))))
