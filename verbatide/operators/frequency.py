"""Counts of words, n-grams, tags and lengths, overall and per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.functions import text as T
from verbatide.operators.rowsets import rank_slice


def explode_words(df: DataFrame, words: Column, name: str, *keep: str) -> DataFrame:
    """One row per list element.

    The outer form is on purpose: with a plain ``explode`` the optimizer infers filters on the
    list's size and evaluates the whole text expression again for each of them.
    """
    return df.select(*keep, F.explode_outer(words).alias(name)).where(F.col(name).isNotNull())


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, nulls left out."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def term_counts(df: DataFrame, words: Column, name: str = "token", by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each word; counts are combined before the shuffle, so common words are cheap."""
    return explode_words(df, words, name, *by).groupBy(*by, name).agg(F.count("*").alias("n"))


def ngram_counts(df: DataFrame, words: Column, n: int) -> DataFrame:
    """Occurrences of each n-gram.

    The word list becomes a column of its own before the shifted reads, behind an outer explode
    of its positions, so the text expression runs once per row and no list of n-grams is built.
    """
    lists = df.select(words.alias("_words"))
    starts = F.when(F.size("_words") >= n, F.sequence(F.lit(1), F.size("_words") - (n - 1)))
    at = lists.select("_words", F.explode_outer(starts).alias("_at")).where(F.col("_at").isNotNull())
    gram = F.concat_ws(" ", *[F.get("_words", F.col("_at") + (i - 1)) for i in range(n)])
    return at.select(gram.alias("ngram")).groupBy("ngram").agg(F.count("*").alias("n"))


def vocabulary_size(df: DataFrame, words: Column, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return explode_words(df, words, "token").agg(count("token").alias("terms"))


def class_corpus(df: DataFrame, label: str, value: str, words: Column) -> DataFrame:
    """All words of one class, one per row."""
    return explode_words(df.where(F.col(label) == value), words, "word")


def _ranked(counts: DataFrame, label: str, word: str, k: int) -> DataFrame:
    order = Window.partitionBy(label).orderBy(F.desc("n"), F.asc(word))
    # The rank filter is applied before the shuffle too: each task sends at most k rows per class.
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def common_words(
    df: DataFrame, label: str, words: Column, stop: Sequence[str], k: int = 40
) -> DataFrame:
    """The k commonest words per class, of which stop words are then dropped."""
    counts = term_counts(df, words, "word", [label])
    ranked = _ranked(counts, label, "word", k)
    return ranked.where(~F.col("word").isin(list(stop))).select(label, "word", "n")


def term_weights(
    df: DataFrame, label: str, words: Column, stop: Sequence[str], k: int = 200
) -> DataFrame:
    """The k commonest words per class without stop words, weighted by the commonest one's count."""
    exploded = explode_words(df, words, "word", label).where(~F.col("word").isin(list(stop)))
    counts = exploded.groupBy(label, "word").agg(F.count("*").alias("n"))
    ranked = _ranked(counts, label, "word", k)
    commonest = F.max("n").over(Window.partitionBy(label))  # over k rows per class
    return ranked.select(label, "word", "n", (F.col("n") / commonest).alias("weight"))


def tag_counts(df: DataFrame, tags: Column, per_tag: bool = False) -> DataFrame:
    """Occurrences of each text's joined tags or, ``per_tag``, of single tags."""
    if per_tag:
        return term_counts(df, tags, "tag")
    joined = df.select(T.join_words(tags).alias("tag"))
    return joined.groupBy("tag").agg(F.count("*").alias("n"))


def popular_tags(
    df: DataFrame, tags: Column, first: int = 2, last: int = 10, per_tag: bool = False
) -> DataFrame:
    """Ranks 2 to 10: the first is normally the texts without any tag."""
    return rank_slice(tag_counts(df, tags, per_tag), first, last, "n", "tag")


def histogram(df: DataFrame, label: str, measure: Column, bins: int = 10) -> DataFrame:
    """Equal-width bins of an integer measure per class, empty bins included.

    Rows are first counted per distinct value, so the range window sees each value once. The last
    bin is closed; a class with a single value gets a range of one around it. Missing values fall
    into no bin: filtering them out would make Spark evaluate the measure twice.
    """
    values = df.where(F.col(label).isNotNull()).select(label, measure.alias("_x"))
    counts = values.groupBy(label, "_x").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(label)
    low, high = F.min("_x").over(whole), F.max("_x").over(whole)
    half = F.when(F.col("_lo") == F.col("_hi"), 0.5).otherwise(0.0)
    ranged = counts.select(label, "_x", "_n", low.alias("_lo"), high.alias("_hi")).select(
        label, "_x", "_n", (F.col("_lo") - half).alias("lo"), (F.col("_hi") + half).alias("hi")
    )
    step = F.floor((F.col("_x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    placed = ranged.withColumn("_bin", F.when(step < bins, step + 1).when(step >= bins, F.lit(bins)))
    wide = placed.groupBy(label, "lo", "hi").agg(
        *[F.sum(F.when(F.col("_bin") == i, F.col("_n")).otherwise(0)).alias(f"_b{i}") for i in range(1, bins + 1)]
    )
    rows = F.array(*[F.struct(F.lit(i).cast("long").alias("bin"), F.col(f"_b{i}").alias("n")) for i in range(1, bins + 1)])
    width = (F.col("hi") - F.col("lo")) / bins
    return wide.where(F.col("lo").isNotNull()).select(label, "lo", "hi", F.inline(rows)).select(
        label,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_from"),
        (F.col("lo") + F.col("bin") * width).alias("bin_to"),
        "n",
    )


def longest(df: DataFrame, text: Column) -> DataFrame:
    return df.agg(F.max(F.length(text)).cast("long").alias("max_length"))
