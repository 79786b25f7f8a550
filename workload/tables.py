"""The given tables in the shapes the queries need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatide.functions import recode as R
from verbatide.functions import text as T
from verbatide.operators.frequency import explode_words


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt to as many partitions as the caller names in ``spark.verbatide.inputPartitions``.

    For text tables that are one small file that Spark cannot split. Unset, nothing is moved: large tables have
    splits enough, and their size is ``spark.sql.files.maxPartitionBytes``.
    """
    wanted = df.sparkSession.conf.get("spark.verbatide.inputPartitions", None)
    return df.repartition(int(wanted)) if wanted else df


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents", "doc_id", "text", *more))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "pages", "page_id", "html"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dealt(table(spark, sf_dir, "conversations", "conv_id", "turn", "text"))
    return df.select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text")


def _score() -> Column:
    return F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1)


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with a class; those without a label are neutral."""
    labels = table(spark, sf_dir, "labels")
    joined = documents(spark, sf_dir).join(labels, "doc_id", "left")
    score = F.coalesce(_score(), F.lit(0)).cast("double")
    return joined.select("doc_id", "text", R.polarity(score).alias("Sentiments"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that have a label, for fitting."""
    labels = table(spark, sf_dir, "labels")
    joined = documents(spark, sf_dir).join(labels, "doc_id")
    score = F.coalesce(_score(), F.lit(0)).cast("double")
    classes = joined.select("doc_id", "text", R.polarity(score).alias("Sentiments"))
    return classes.withColumn("Feelings", R.class_code(F.col("Sentiments")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (prediction, label, score) table over all of lineitem: the return flag is the class, the
    quantity stands for the predictor, the price for its score."""
    df = table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    return df.select(
        F.when(quantity < 15, 0.0).when(quantity < 40, 1.0).otherwise(2.0).alias("prediction"),
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("label"),
        (F.col("l_extendedprice") / 100000).alias("score"),
    )


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is null for errors and not a number for signups."""
    value = F.when(F.col("event_type") == "error", None).when(
        F.col("event_type") == "signup", float("nan")
    )
    df = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    kept = ~F.col("event_type").isin("error", "signup")
    return df.withColumn("value", value.when(kept, F.col("value")))


def abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each short benchmark word, expanded to the first and last longer word that begin with it."""
    bench = table(spark, sf_dir, "benchmark", "text")
    words = explode_words(bench, T.split_words(T.strip_noise(F.col("text"))), "word").distinct()
    long = words.where(F.length("word") > 3).select("word", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("_n"))
    starts = long.groupBy(F.substring("word", F.lit(1), F.col("_n")).alias("abbrev"))
    expansions = starts.agg(F.concat_ws(" ", F.min("word"), F.max("word")).alias("expansion"))
    short = words.where(F.length("word") <= 3).select(F.col("word").alias("abbrev"))
    return expansions.join(short, "abbrev", "left_semi")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the conversations, known as verbs and as nouns."""
    talk = conversations(spark, sf_dir)
    words = explode_words(talk, T.split_words(T.strip_noise(F.col("text"))), "lemma").distinct()
    kinds = F.explode(F.array(F.lit("n"), F.lit("v"))).alias("pos")
    return words.where(F.length("lemma") >= 3).select("lemma", kinds)


def exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longer benchmark words as irregular forms of their first four letters."""
    bench = table(spark, sf_dir, "benchmark", "text")
    words = explode_words(bench, T.split_words(T.strip_noise(F.col("text"))), "form").distinct()
    long = words.where(F.length("form") > 4)
    return long.select("form", F.lit("v").alias("pos"), F.substring("form", 1, 4).alias("lemma"))
