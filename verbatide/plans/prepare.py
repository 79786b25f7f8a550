"""From raw tables to the cleaned, labelled table: one lazy plan, no intermediate stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import recode as R
from verbatide.functions import text as T
from verbatide.operators import profile
from verbatide.operators.lexicon import expand_abbreviations
from verbatide.operators.rowsets import union_by_name

CANONICAL = ["Location", "OriginalTweet", "TweetAt", "Feelings", "Sentiments"]
CLEANED = ["Location", "Feelings", "Sentiments", "TweetAt", "ctext"]


def from_five_levels(df: DataFrame) -> DataFrame:
    """The table with a five-level text sentiment in canonical form."""
    classes = df.withColumn("Sentiments", R.collapse_levels(F.col("Sentiment")))
    return classes.withColumn("Feelings", R.class_code(F.col("Sentiments"))).select(*CANONICAL)


def from_scores(
    df: DataFrame, date_format: str | None = None, impute: bool = True, key: str | None = None
) -> DataFrame:
    """The table with numeric sentiments and a date in canonical form.

    Duplicates go first, ``key`` being an id that tells them apart and does not count; then missing scores take the mean. With ``impute`` off they stay missing
    and become neutral, instead of taking the mean's sign.
    """
    numbers = df.withColumn("Sentiments", R.to_number(F.col("Sentiments")))
    rows = profile.drop_duplicates(numbers, key) if key else profile.drop_duplicates(numbers)
    if impute:
        rows = profile.impute_mean(rows, "Sentiments")
    parts = R.date_parts(R.to_moment(F.col("Date"), date_format))
    day = R.date_from_parts(parts["year"], parts["month"], parts["day"])
    recoded = R.rename(rows, Text="OriginalTweet").withColumn("TweetAt", R.day_text(day))
    recoded = recoded.withColumn("Sentiments", R.polarity(F.col("Sentiments")))
    return recoded.withColumn("Feelings", R.class_code(F.col("Sentiments"))).select(*CANONICAL)


def clean_table(canonical: DataFrame, abbreviations: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Cleaner A over the canonical table, in the saved projection. Abbreviations are a few pairs or a
    table (abbrev, expansion); a stream takes pairs."""
    if isinstance(abbreviations, DataFrame):
        texts = canonical.withColumn("OriginalTweet", T.as_text(F.col("OriginalTweet")))
        return expand_abbreviations(texts, "OriginalTweet", abbreviations).select(*CLEANED)
    text = T.as_text(F.col("OriginalTweet"))
    return canonical.withColumn("ctext", T.clean_a(text, abbreviations)).select(*CLEANED)


def prepare(
    five_level: DataFrame, scored: DataFrame, abbreviations: Mapping[str, str] | DataFrame | None = None
) -> DataFrame:
    """Both inputs in one cleaned table."""
    return clean_table(union_by_name(from_five_levels(five_level), from_scores(scored)), abbreviations)
