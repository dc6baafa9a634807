"""Toxicity by multiple-instance learning: documents are bags of sentences, and only bags are labelled.

A sentence has the logistic score of its words; a document is toxic if any sentence is, so the
scores are combined by noisy-or, 1 - prod(1 - p). The likelihood of the document labels trains the
sentence weights, which then locate the offending sentences.

A word counts as itself and as its beginnings. Of these features the few thousand that tell
toxic documents best are kept. Training rows are a bounded sample of the labelled documents
(``max_documents`` by a hash of the id), and the features' counts are summed in the cluster. Each step of the fit is
one job over a written table; one gradient per task reaches the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import column, sent, written

MAX_DOCUMENTS = 20_000
MAX_FEATURES = 2048
LEAST_DOCUMENTS = 3
LEAST_Z = 2.0
STEPS = 40
STEP_SIZE = 0.3
SHRINK = 1e-5
FIRST_BIAS = -5.0
THRESHOLD = 0.7
MIN_PREFIX, MAX_PREFIX = 3, 7
FLUSH = 200_000
CACHE = 200_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    """The lower-case word itself and its beginnings."""
    return ["=" + word] + [word[:k] for k in range(MIN_PREFIX, min(MAX_PREFIX, len(word)) + 1)]


def _feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents that hold the feature, by label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def summed() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            both = [pa.array([c[f] for f in names], pa.int64()) for c in (seen[1], seen[0])]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *both], ["feature", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = set(WORD.findall((text.as_py() or "").lower()))
                seen[label].update({f for w in words for f in features(w)})
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield summed()
                    seen[0].clear(), seen[1].clear()
        yield summed()

    parts = rows.mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(rows: DataFrame, max_features: int) -> dict[str, float]:
    """Feature to first weight: those whose log odds for toxic documents are furthest above zero in standard errors."""
    totals = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic, clean = totals[0] or 0, totals[1] - (totals[0] or 0)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (F.lit(toxic + 1.0) - F.col("toxic") - 0.5)) - F.log(b / (F.lit(clean + 1.0) - F.col("clean") - 0.5))
    ranked = _feature_counts(rows).where(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS).select(
        "feature", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    best = ranked.where(F.col("z") > LEAST_Z).orderBy(F.desc("z"), "feature").limit(max_features)
    return {r["feature"]: 0.5 * r["odds"] for r in best.collect()}


@dataclass
class Model:
    """Weights of the kept features and the bias of a sentence."""

    weights: dict[str, float]
    bias: float

    def scorer(self) -> SentenceScorer:
        return SentenceScorer(self)


class SentenceScorer:
    """Scores texts in a task; the weights of words seen lately are kept."""

    def __init__(self, model: Model):
        self.model, self.words = model, {}

    def word(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            get = self.model.weights.get
            found = self.words[word] = sum(get(f, 0.0) for f in features(word))
        return found

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(start, end) of each sentence, in code points, and its probability of being toxic."""
        spans, logits = [], []
        for m in SENTENCE.finditer(text):
            words = WORD.findall(m.group().lower())
            if words:
                spans.append(m.span())
                logits.append(sum(map(self.word, words)))
        z = np.clip(np.array(logits, float) + self.model.bias, -40, 40)
        return spans, 1 / (1 + np.exp(-z))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def _bags(rows: DataFrame, names: list[str]) -> DataFrame:
    """Training rows reduced to kept features: label, sentences without any, and the places of the others'."""
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, lengths, places = [], [], []
            for text in batch.column(0):
                empty, sizes, found = 0, [], []
                for sentence in SENTENCE.findall((text.as_py() or "").lower()):
                    words = WORD.findall(sentence)
                    here = [place[f] for w in words for f in features(w) if f in place]
                    empty += bool(words) and not here
                    if here:
                        sizes.append(len(here))
                        found += here
                plain.append(empty), lengths.append(sizes), places.append(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(batch.column(1).to_pylist(), pa.int32()), pa.array(plain, pa.int64()),
                pa.array(lengths, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32())),
            ], ["label", "plain", "lengths", "places"])

    return rows.mapInArrow(run, "label int, plain bigint, lengths array<int>, places array<int>")


def _gradient(bags: DataFrame, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float, int]:
    """Gradient of the documents' log likelihood, summed over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, of_bias, rows = np.zeros(len(weights)), 0.0, 0
        p_plain = 1 / (1 + np.exp(-bias))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label, plain = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sizes, places = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            per_doc = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(n), per_doc)
            sentence = np.repeat(np.arange(len(sizes)), sizes)
            z = np.clip(np.bincount(sentence, weights[places], len(sizes)) + bias, -30, 30)
            p = 1 / (1 + np.exp(-z))
            none = np.bincount(doc, np.log1p(-p), n) + plain * np.log1p(-p_plain)  # log of no sentence being toxic
            none = np.minimum(none, -1e-9)
            pull = np.where(label == 1, np.exp(none) / -np.expm1(none), -1.0)
            by_sentence = p * pull[doc]
            total += np.bincount(places, by_sentence[sentence], len(weights))
            of_bias += by_sentence.sum() + (plain * p_plain * pull).sum()
            rows += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.tobytes()], pa.binary()), pa.array([of_bias]), pa.array([rows], pa.int64())], ["w", "b", "n"])

    parts = bags.mapInArrow(run, "w binary, b double, n bigint").collect()
    total = np.zeros(len(weights))
    for part in parts:
        total += np.frombuffer(part["w"])
    return total, sum(p["b"] for p in parts), sum(p["n"] for p in parts)


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_documents: int = MAX_DOCUMENTS, max_features: int = MAX_FEATURES) -> Model:
    """Fit the model on labelled documents for which ``usable`` (a condition on the id) holds.

    Several labels of an id count as their largest; NULL labels and ids are passed over. About ``max_documents``
    labelled documents are used, all if there are fewer. Without labels every score is that of the first bias.
    """
    draw = F.shiftrightunsigned(F.xxhash64(column(id_col), F.lit("toxicity")), 11) / F.lit(float(2**53))
    known = labels.where(usable & column(label_col).isNotNull() & column(id_col).isNotNull()).groupBy(
        column(id_col).cast("bigint").alias("labelled")).agg(F.max(column(label_col)).cast("int").alias("label"))
    share = min(1.0, max_documents / max(1, known.count()))
    sample = known.withColumnRenamed("labelled", id_col).where(draw <= share).withColumnRenamed(id_col, "labelled")
    texts = docs.where(usable & (draw <= share)).select(column(id_col).cast("bigint").alias("labelled"), column(text_col).alias("text"))
    # The sample's ids are bounded by max_documents, whatever the table's size.
    rows = texts.join(F.broadcast(sample), "labelled").select("text", "label")
    rows = written(rows, "labelled")
    first = choose_features(rows, max_features)
    names = sorted(first)
    bags = written(_bags(rows, names), "bags")
    x = np.array([first[f] for f in names] + [FIRST_BIAS])
    mean, square = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, STEPS + 1):  # Adam on the mean log likelihood
        of_weights, of_bias, n = _gradient(bags, x[:-1], x[-1])
        slope = np.append(of_weights, of_bias) / max(1, n) - SHRINK * np.append(x[:-1], 0.0)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        x = x + STEP_SIZE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8) / np.sqrt(step)
    return Model(dict(zip(names, x[:-1].tolist())), float(x[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, score, predicted, n_sentences and the offending sentences.

    ``offending`` lists (start, end, p), in code points, of the sentences whose own probability reaches one half. A NULL
    text or one without words has score 0. Texts are scored whole, whatever their length. Repeated rows get the same score; a NULL id is kept;
    other columns are not read; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores, counts, offending = [], [], []
            for text in batch.column(1):
                spans, p = scorer.sentences(text.as_py() or "")
                scores.append(noisy_or(p)), counts.append(len(spans))
                offending.append([{"start": s, "end": e, "p": float(q)} for (s, e), q in zip(spans, p) if q >= 0.5])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
                pa.array(counts, pa.int64()), pa.array(offending, _OFFENDING)], ["doc_id", "score", "predicted", "n_sentences", "offending"])

    scored = sent(docs.select(column(id_col).cast("bigint"), column(text_col))).mapInArrow(
        run, "doc_id bigint, score double, predicted int, n_sentences bigint, offending array<struct<start:bigint,end:bigint,p:double>>")
    return scored.withColumnRenamed("doc_id", id_col)


_OFFENDING = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
