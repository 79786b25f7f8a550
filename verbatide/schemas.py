"""Declared schemas of the input tables; inference is opt-in, in the readers."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType(), True) for name in names]


TEXTS_FIVE_LEVEL = StructType(_strings("Location", "OriginalTweet", "TweetAt", "Sentiment"))
TEXTS_SCORED = StructType(_strings("Text", "Location", "Date", "Sentiments"))
TEXTS_CLEAN = StructType(_strings("Location", "Feelings", "Sentiments", "TweetAt", "ctext"))
ABBREVIATIONS = StructType(_strings("abbrev", "expansion"))
LEMMA_EXCEPTIONS = StructType(_strings("form", "pos", "lemma"))
LEXICON = StructType(_strings("lemma", "pos"))
TAG_COUNTS = StructType(_strings("token", "tag") + [StructField("n", LongType(), True)])
PREDICTIONS = StructType(
    [StructField(name, DoubleType(), True) for name in ("prediction", "label", "score")]
)
