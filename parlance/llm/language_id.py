"""Language identification by compression with one zstandard dictionary per language.

A text is in the language whose raw-content dictionary makes it smallest. Dictionaries are learned from a bounded
sample: of every language the ``DOCUMENTS`` labelled documents with the smallest hash of their id,
``SAMPLE_CHARS`` code points from the middle of each. Texts are compressed whole, block by block, so the
dictionary counts as much at the end of a long text as at its start.

How much the best must save over the second best is learned from the same sample: each excerpt is compressed with the
dictionaries of the other folds, once with and once without its own language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import column, packed, sent

DOCUMENTS = 200
SAMPLE_CHARS = 1024
MAX_LANGUAGES = 200  # 40 MB of dictionaries in a task at most
BLOCK = 4096
SMALL_BLOCK = 64
CLEAR = 0.02
LEVEL = 6
UNKNOWN = "und"
FOLDS = 4
# Without a learned margin, what is narrow by ``CLEAR`` is rejected.
MARGIN = CLEAR
_BLANKS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def excerpts(labelled: DataFrame, text: Column, lang: Column, id_col: Column,
             documents: int = DOCUMENTS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Language to excerpts; the language with the most labelled documents first, then by code point.

    Rows without language, text or letters are passed over, as is the label ``und``. The sample is
    bounded by documents * chars for each language, and by an error beyond ``MAX_LANGUAGES`` languages.
    """
    rows = labelled.select(text.alias("text"), lang.alias("lang"), F.xxhash64(id_col, F.lit("lang")).alias("draw"))
    rows = rows.where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}"))
    middle = F.greatest(F.lit(1), (F.length("text") - chars) / 2 + 1).cast("int")
    by_draw = W.partitionBy("lang").orderBy("draw", "excerpt")
    sample = (
        rows.select("lang", "draw", F.substring(F.col("text"), middle, F.lit(chars)).alias("excerpt"))
        .withColumn("k", F.row_number().over(by_draw)).where(F.col("k") <= documents)
    )
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found: dict[str, list[str]] = {row["lang"]: [] for row in known}
    for row in sample.orderBy("lang", "k").toLocalIterator():
        found[row["lang"]].append(row["excerpt"])
    return found


def contents(found: dict[str, list[str]]) -> dict[str, bytes]:
    return {lang: plain("\n".join(texts)) for lang, texts in found.items() if texts}


def learn_dictionaries(labelled: DataFrame, text: Column, lang: Column, id_col: Column,
                       documents: int = DOCUMENTS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Language to dictionary content, from ``excerpts``."""
    return contents(excerpts(labelled, text, lang, id_col, documents, chars))


def learn(labelled: DataFrame, text: Column, lang: Column, id_col: Column) -> tuple[dict[str, bytes], float]:
    """Dictionaries and the margin that goes with them, from one sample."""
    found = excerpts(labelled, text, lang, id_col)
    return contents(found), learn_margin(labelled.sparkSession, found)


def learn_margin(spark: SparkSession, found: dict[str, list[str]]) -> float:
    """The score that best parts known from unknown languages.

    Every excerpt is scored by the dictionaries of the other folds: with its own language it should be kept, if
    labelled right, and without it rejected. With fewer than three languages nothing can be left out, and the
    answer is ``MARGIN``.
    """
    trials = sorted((k % FOLDS, lang, text) for lang, texts in found.items() for k, text in enumerate(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[list[str], list[zstandard.ZstdCompressor]]] = {}
        for batch in batches:
            scored = []
            for fold, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if fold not in made:
                    others = contents({n: [t for k, t in enumerate(ts) if k % FOLDS != fold] for n, ts in found.items()})
                    made[fold] = list(others), compressors(others)
                names, tools = made[fold]
                if lang in names and len(names) > 2:
                    label, score = classify(text, names, tools)
                    own = names.index(lang)
                    scored.append((lang, label == lang, score))
                    scored.append((lang, False, classify(text, names[:own] + names[own + 1 :], tools[:own] + tools[own + 1 :])[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in scored], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.float64()))], ["lang", "known", "score"])

    if len(found) < 3:
        return MARGIN
    rows = spark.createDataFrame(trials, "fold int, lang string, text string").mapInArrow(run, "lang string, known boolean, score double")
    return parting([tuple(row) for row in rows.collect()])


def parting(scored: list[tuple[str, bool, float]]) -> float:
    """The cut with the least sum of lost known and kept unknown texts, every language counting alike; in the widest gap of several."""
    size = Counter((lang, known) for lang, known, _ in scored)
    if {known for _, known in size} != {True, False}:
        return MARGIN
    # From the lowest cut on: all known are kept, and so are all unknown.
    steps = sorted((score, 1 / size[lang, known] if known else -1 / size[lang, known]) for lang, known, score in scored)
    errors = list(accumulate(step for _, step in steps))
    gaps = [(round(e, 9), a - b, (a + b) / 2) for e, (a, _), (b, _) in zip(errors, steps, steps[1:]) if a < b]
    return min(gaps)[2] if gaps else MARGIN


def plain(text: str) -> bytes:
    """Lower-case UTF-8 with single blanks for digits, ASCII punctuation and white space, which tell nothing of a language."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKS).split())


def blocks(text: bytes, size: int) -> list[bytes]:
    return [text[at : at + size] for at in range(0, len(text), size)]


def compressors(dictionaries: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    made = []
    for content in dictionaries.values():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False))
    return made


def classify(text: str | None, names: list[str], tools: list[zstandard.ZstdCompressor]) -> tuple[str, float]:
    """(language, score): the score is the share of bytes that the best dictionary saves over the second best."""
    if not text or not names or not _LETTER.search(text):
        return UNKNOWN, 0.0
    content, sizes = plain(text), [0] * len(tools)
    for size in (BLOCK, SMALL_BLOCK):
        parts = blocks(content, size)
        sizes = [seen + sum(len(tool.compress(part)) for part in parts) for seen, tool in zip(sizes, tools)]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        second = sizes[order[1]] if len(order) > 1 else sum(map(len, parts)) + len(parts)
        score = max(0.0, 1.0 - sizes[order[0]] / max(1, second))
        if score >= CLEAR:  # a narrow text is compressed once more in small blocks, which lean on the dictionary alone
            break
    return names[order[0]], score


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The input's columns as they are, in a struct ``_row``, beside lang_pred, score and rejected.

    A NULL text or one without a letter is ``und`` with score 0, and rejected. Otherwise the text gets the language
    of the smallest result; ties go to the language learned from more documents. It is rejected if the best saves less than
    ``margin`` over the second best. With no language learned, all is ``und``. Texts are compressed whole, in blocks, so
    a very long one needs memory for itself alone. Repeated rows get the same answer each; an empty table gives no rows.
    Rows stay where they are: only their texts go to the Python task, once, and only the answers come back.
    """
    names = list(dictionaries)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tools = compressors(dictionaries)
        for texts in batches:
            found = [classify(text.as_py(), names, tools) for text in texts]
            yield pa.StructArray.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64()))], ["lang_pred", "score"])

    # Said to be nondeterministic, so that a condition on the answer is not a second call.
    answer = F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()
    found = packed(sent(docs), found=answer(column(text_col))).select("_row", "found.*")
    return found.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < margin))
