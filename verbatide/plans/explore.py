"""Word statistics of a cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.functions import text as T
from verbatide.operators import features, frequency
from verbatide.operators.rowsets import top_k


def content_words(text: Column) -> Column:
    """Lower-cased words without ASCII punctuation and without stop words."""
    return features.without_stop_words(T.split_words(T.strip_punctuation(F.lower(text))))


def top_words(df: DataFrame, text: str, k: int = 20) -> DataFrame:
    """The commonest words that are not stop words."""
    counts = frequency.term_counts(df, content_words(F.col(text)))
    return top_k(counts, k, "n", "token")


def top_ngrams(df: DataFrame, text: str, n: int, k: int = 10) -> DataFrame:
    counts = frequency.ngram_counts(df, content_words(F.col(text)), n)
    return top_k(counts, k, "n", "ngram")
