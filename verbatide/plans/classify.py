"""Text classification: one pipeline from words to predictions, fitted once on training rows.

Labels are indexed beside the pipeline, not in it: scoring needs no label and returns every row. In an evaluated
part, a label that training did not have takes an index that is never predicted, so it counts as an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions.text import split_words, strip_punctuation
from verbatide.operators import features, metrics
from verbatide.operators.lexicon import lemmatise
from verbatide.operators.rowsets import nested_holdout
from verbatide.plans.explore import content_words


def add_words(df: DataFrame, text: str, lexicon: DataFrame | None = None, pos: str = "v") -> DataFrame:
    """Adds the list column ``words``: lower-cased, unpunctuated, as lemmas of ``lexicon(lemma, pos)``
    if one is given, without stop words."""
    if lexicon is None:
        return df.withColumn("words", content_words(F.col(text)))
    words = df.withColumn("words", split_words(strip_punctuation(F.lower(text))))
    lemmas = lemmatise(words, "words", lexicon, pos)
    return lemmas.withColumn("words", features.without_stop_words(F.col("words")))


def index_labels(train: DataFrame, label: str = "Feelings") -> StringIndexerModel:
    """One code per class of the training rows; other labels, and missing ones, share one more."""
    return features.label_indexer(label).fit(train.where(F.col(label).isNotNull())).setHandleInvalid("keep")


def with_labels(df: DataFrame, index: StringIndexerModel) -> DataFrame:
    """Adds the label's code, as a plain number."""
    coded = index.transform(df)
    return coded.withColumn("indexedLabel", F.col("indexedLabel").cast("double").alias("indexedLabel", metadata={}))


def text_pipeline(classifier: Estimator, width: int, grams: int = 1) -> Pipeline:
    """Optionally build n-grams, hash, classify rows with ``indexedLabel``."""
    stages = []
    source = "words"
    if grams > 1:
        stages.append(features.ngram(grams))
        source = "ngrams"
    return Pipeline(stages=[*stages, features.hashing_tf(width, source), classifier])


@dataclass
class Evaluation:
    model: PipelineModel
    labels: StringIndexerModel
    validation: DataFrame
    test: DataFrame

    def report(self, part: str = "test") -> DataFrame:
        """Classification report of the part that was asked for."""
        scored = self.validation if part == "validation" else self.test
        return metrics.classification_report(scored, "prediction", "indexedLabel")


def fit_and_score(
    classifier: Estimator,
    train: DataFrame,
    test: DataFrame,
    key: str,
    width: int,
    grams: int = 1,
    label: str = "Feelings",
    seed: int = 5043,
) -> Evaluation:
    """Split as ``nested_holdout``, fit on the training part, score the other two."""
    training, validation, final = nested_holdout(train, test, key, seed)
    labels = index_labels(training, label)
    known = with_labels(training.where(F.col(label).isNotNull()), labels)
    with features.cached(known.select("words", "indexedLabel")) as (rows,):
        model = text_pipeline(classifier, width, grams).fit(rows)
    scored = [model.transform(with_labels(part, labels)) for part in (validation, final)]
    return Evaluation(model, labels, *scored)
