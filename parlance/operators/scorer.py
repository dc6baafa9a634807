"""A preference scorer: logistic regression on hashed word counts, or on columns that are given."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import words


def hashed_counts(df: DataFrame, text: str, dimensions: int = 1 << 14) -> DataFrame:
    """Add the sparse word-count vector ``features``; a fixed width, no vocabulary pass.

    A missing text counts as one without words.
    """
    none = F.array().cast("array<string>")
    tokens = df.withColumn("_words", F.coalesce(words(F.col(text)), none))
    return HashingTF(inputCol="_words", outputCol="features", numFeatures=dimensions).transform(tokens).drop("_words")


def preference_scores(train: DataFrame, evaluate: DataFrame, text: str = "text", label: str = "label",
                      dimensions: int = 1 << 14, iterations: int = 20, regularisation: float = 0.01) -> DataFrame:
    """``evaluate`` with the logit ``score`` of a scorer fitted on ``train``.

    Training is distributed: each iteration is a tree aggregation of a gradient of
    ``dimensions`` numbers.
    """
    fit = LogisticRegression(labelCol=label, maxIter=iterations, regParam=regularisation)
    model = fit.fit(hashed_counts(train, text, dimensions).select(label, "features"))
    scored = model.transform(hashed_counts(evaluate, text, dimensions))
    return scored.withColumn("score", vector_to_array("rawPrediction")[1]).select(*evaluate.columns, "score")


def _fit(train: DataFrame, features: list[str], label: str, regularisation: float) -> LogisticRegressionModel:
    """The minimum of the mean loss plus half the squared weights times ``regularisation``; the bias is free."""
    fit = LogisticRegression(labelCol=label, regParam=regularisation, standardization=False, maxIter=500, tol=1e-12)
    return fit.fit(VectorAssembler(inputCols=features, outputCol="features").transform(train).select(label, "features"))


def fit(train: DataFrame, features: list[str], label: str = "label", regularisation: float = 0.01) -> DataFrame:
    """``feature, weight`` of a scorer on numeric columns without gaps, and its ``bias``."""
    model = _fit(train, features, label, regularisation)
    weights = [("bias", float(model.intercept)), *zip(features, map(float, model.coefficients))]
    return train.sparkSession.createDataFrame(weights, "feature string, weight double")


def fitted_scores(train: DataFrame, evaluate: DataFrame, features: list[str], label: str = "label",
                  regularisation: float = 0.01) -> DataFrame:
    """``evaluate`` with the logit ``score`` of a scorer on numeric columns, fitted on ``train``."""
    model = _fit(train, features, label, regularisation)
    score = F.lit(float(model.intercept))
    for name, weight in zip(features, model.coefficients):
        score = score + F.lit(float(weight)) * F.col(name)
    return evaluate.withColumn("score", score)
