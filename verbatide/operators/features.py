"""Features as tables (term counts, weights, sequences) and as Spark ML stages (vectors)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model, Transformer
from pyspark.ml.feature import (
    IDF,
    Binarizer,
    CountVectorizerModel,
    HashingTF,
    IndexToString,
    NGram,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from verbatide.functions import fixed_values as V
from verbatide.operators.frequency import explode_words
from verbatide.operators.ordering import dense_index
from verbatide.operators.skew import lookup_join
from verbatide.session import materialise, scratch_path


def stop_list() -> list[str]:
    """Spark's English stop words and the extra marks."""
    return StopWordsRemover.loadDefaultStopWords("english") + V.STOP_MARKS


def without_stop_words(words: Column, stop: Sequence[str] | None = None) -> Column:
    """Case-insensitive removal, as the ML stage does, but as a native expression."""
    folded = list({w.lower(): None for w in (stop_list() if stop is None else stop)})
    return F.filter(words, lambda w: ~F.lower(w).isin(folded))


def lower_tokens(text: Column, drop_empty: bool = True) -> Column:
    """Lower case, split at every single whitespace character.

    Double spaces give empty words, which models would see as a feature of their own;
    ``drop_empty`` removes them.
    """
    words = F.split(F.lower(text), r"\s")
    return F.array_remove(words, "") if drop_empty else words


# Tables ----------------------------------------------------------------------------------------


def term_frequencies(df: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, term, tf). Whole word lists are dealt by key and counted where they arrive: a list is several times
    smaller than its rows of counts, and uses of one table share the lists' shuffle and its cut texts."""
    lists = df.select(key, words.alias("_words")).repartition(key)
    return explode_words(lists, F.col("_words"), "term", key).groupBy(key, "term").agg(F.count("*").alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """Texts per term. The count reads ``tf`` so that column pruning leaves the same shuffle as for
    ``tf`` itself, and Spark reuses it instead of splitting the texts again."""
    return tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def idf_table(tf: DataFrame, documents: Column) -> DataFrame:
    """ln((n + 1) / (df + 1)) per term; ``documents`` is n, empty texts included."""
    idf = F.log((documents + 1) / (F.col("df") + 1))
    return document_frequencies(tf).withColumn("idf", idf)


def tfidf(tf: DataFrame, key: str, documents: Column) -> DataFrame:
    """tf · (ln((1 + n) / (1 + df)) + 1), each text's row scaled to length one."""
    frequencies = document_frequencies(tf)
    # df is each term's number of rows in tf, so the hot terms of the join are known beforehand.
    # df is each term's number of rows in tf, so the hot terms of the join are known beforehand.
    joined = lookup_join(tf, frequencies, "term", frequencies.select("term", F.col("df").alias("n")))
    return _scaled(joined, key, "df", F.col("tf") * (F.log((documents + 1) / (F.col("df") + 1)) + 1))


def _scaled(joined: DataFrame, key: str, of: str, raw: Column) -> DataFrame:
    """(key, term, tf, tfidf): ``raw``, made from tf and the term's ``of``, scaled to length one per text.

    Rows come from the join in order of their terms. What differs between neighbours, key and tf, travels side by side
    and the weight is made on arrival, so the shuffle compresses well."""
    weighted = joined.select(key, "tf", "term", of).repartition(key).select(key, "term", "tf", raw.alias("_raw"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "tf", (F.col("_raw") / norm).alias("tfidf"))


@dataclass(frozen=True)
class TfIdf:
    """Weights fitted on one table, to be applied to any: ``terms(term, idf)``."""

    terms: DataFrame

    @classmethod
    def fit(cls, tf: DataFrame, documents: Column | int) -> TfIdf:
        """idf = ln((1 + n) / (1 + df)) + 1 from ``tf(key, term, tf)`` of n texts."""
        n = F.lit(documents) if isinstance(documents, int) else documents
        idf = F.log((n + 1) / (F.col("df") + 1)) + 1
        return cls(materialise(document_frequencies(tf).select("term", idf.alias("idf"))))

    def apply(self, tf: DataFrame, key: str) -> DataFrame:
        """(key, term, tf, tfidf): each text's row scaled to length one; terms not fitted drop out."""
        return _scaled(lookup_join(tf, self.terms, "term"), key, "idf", F.col("tf") * F.col("idf"))


def binarise(weights: DataFrame, weight: str, threshold: float = 0.1) -> DataFrame:
    return weights.withColumn(weight, F.when(F.col(weight) > threshold, 1.0).otherwise(0.0))


def word_index(counts: DataFrame, word: str = "word") -> DataFrame:
    """Ranks 1, 2, … by falling count, ties by word, from ``counts(word, n)``."""
    return dense_index(counts, [F.desc("n"), F.asc(word)], "id", start=1)


def word_sequences(df: DataFrame, key: str, words: Column, index: DataFrame) -> DataFrame:
    """(key, sequence): each text's words as ids of ``index(word, id)``; unknown words drop out."""
    placed = df.select(key, F.posexplode_outer(words).alias("_at", "word"))
    found = lookup_join(placed.where(F.col("word").isNotNull()), index.select("word", F.col("id").alias("_id")), "word")
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_id"))).getField("_id")
    lists = found.groupBy(key).agg(ordered.alias("sequence"))
    empty = F.array().cast("array<bigint>")
    return df.select(key).join(lists, key, "left").select(key, F.coalesce("sequence", empty).alias("sequence"))


def pad(sequence: Column, length: int) -> Column:
    """Fixed length: zeros after short sequences, the front cut off long ones."""
    cut = F.when(F.size(sequence) > length, F.slice(sequence, -length, length)).otherwise(sequence)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(length) - F.size(cut))
    return F.concat(cut, zeros)


def vector_total(vector: Column | str) -> Column:
    """The sum of a vector's components, from those it stores: no array of the vector's whole width is made."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda a, b: a + b)


# Spark ML stages -------------------------------------------------------------------------------


def tokenizer(source: str = "filtered_lemmas", to: str = "words") -> Tokenizer:
    return Tokenizer(inputCol=source, outputCol=to)


def regex_tokenizer(source: str = "filtered_lemmas", to: str = "words") -> RegexTokenizer:
    return RegexTokenizer(inputCol=source, outputCol=to, pattern="\\W")


def stop_remover(source: str = "lemmas", to: str = "filtered_lemmas") -> StopWordsRemover:
    return StopWordsRemover(inputCol=source, outputCol=to, stopWords=stop_list())


def ngram(n: int, source: str = "words", to: str = "ngrams") -> NGram:
    return NGram(n=n, inputCol=source, outputCol=to)


def hashing_tf(features: int, source: str = "words", to: str = "rawFeatures") -> HashingTF:
    return HashingTF(numFeatures=features, inputCol=source, outputCol=to)


MAX_VOCABULARY = 2_000_000  # terms that the ML stages may hold on the driver and in every task


def vocabulary(df: DataFrame, words: Column) -> list[str] | DataFrame:
    """All terms by falling count, ties by term. More than ``MAX_VOCABULARY`` stay a table (term, n, id), with the
    places in that order as ids."""
    counts = materialise(explode_words(df, words, "term").groupBy("term").agg(F.count("*").alias("n")))
    if counts.count() > MAX_VOCABULARY:
        return materialise(dense_index(counts, [F.desc("n"), F.asc("term")], "id"))
    return counts.orderBy(F.desc("n"), "term").select("term").toArrow()["term"].to_pylist()


def count_vectorizer(
    terms: Sequence[str] | DataFrame, source: str = "words", to: str = "rawFeatures"
) -> CountVectorizerModel | TermVectorizer:
    """Counts of the given terms; none is dropped by a size.

    A list of terms reaches Spark's model as a saved one: handed over singly, a million would take minutes.
    A table of terms stays a table.
    """
    if isinstance(terms, DataFrame):
        return TermVectorizer(terms, source, to)
    model = CountVectorizerModel.from_vocabulary(list(terms[:1]), inputCol=source, outputCol=to)
    if len(terms) <= 1:
        return model
    spark = SparkSession.active()
    path = scratch_path(spark, "vocabulary")
    model.copy({model.vocabSize: len(terms)}).write().save(path)
    whole = pa.table({"vocabulary": pa.array([list(terms)], pa.list_(pa.string()))})
    spark.createDataFrame(whole).write.mode("overwrite").parquet(f"{path}/data")
    return CountVectorizerModel.load(path)


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, written, with a number ``_row`` for each of its rows."""
    return materialise(df.withColumn("_row", F.monotonically_increasing_id()))


def _with_vectors(rows: DataFrame, cells: DataFrame, size: int | Column, to: str) -> DataFrame:
    """``rows`` with a sparse vector ``to`` of the ``cells(_row, id, value)`` of each; rows without cells have one of zeros.

    Vectors are written as what they consist of and read as vectors, so no row passes through Python.
    """
    pairs = F.sort_array(F.collect_list(F.struct("id", "value")))
    lists = cells.repartition("_row").groupBy("_row").agg(pairs.alias("_cells"))  # lists are made once, where they are read
    joined = rows.drop(to).join(lists, "_row", "left")
    stored = joined.withColumns({
        "_ids": F.coalesce(F.transform("_cells", lambda c: c["id"].cast("int")), F.array().cast("array<int>")),
        "_values": F.coalesce(F.transform("_cells", lambda c: c["value"].cast("double")), F.array().cast("array<double>")),
    })
    size = F.lit(size) if isinstance(size, int) else size
    parts = [F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"), F.col("_ids").alias("indices"), F.col("_values").alias("values")]
    kept = [c for c in rows.columns if c not in (to, "_row")]
    path = scratch_path(rows.sparkSession, "vectors")
    stored.select(*kept, F.struct(*parts).alias(to)).write.parquet(path)
    schema = StructType([*(rows.schema[c] for c in kept), StructField(to, VectorUDT())])
    return rows.sparkSession.read.schema(schema).parquet(path).select(*[c for c in rows.columns if c in kept and c != to], to)


class TermVectorizer(Transformer):
    """The counts of CountVectorizerModel for ``terms(term, n, id)`` that stay a table, however many they are."""

    def __init__(self, terms: DataFrame, source: str = "words", to: str = "rawFeatures"):
        super().__init__()
        self.terms, self.source, self.to = terms, source, to

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, size = _numbered(dataset), self.terms.count()
        tf = term_frequencies(rows, "_row", F.col(self.source))
        found = lookup_join(tf, self.terms.select("term", "id"), "term", self.terms.select("term", "n"))
        return _with_vectors(rows, found.select("_row", "id", F.col("tf").alias("value")), size, self.to)


class TermIDF(IDF):
    """Spark's IDF; of vectors wider than ``MAX_VOCABULARY`` the weights stay a table."""

    def _fit(self, dataset: DataFrame) -> Model:
        source = self.getInputCol()
        one = dataset.where(F.col(source).isNotNull()).select(F.unwrap_udt(source)["size"]).first()
        if one is None or (one[0] or 0) <= MAX_VOCABULARY:
            return super()._fit(dataset)
        vector = F.unwrap_udt(source)
        cells = dataset.select(F.explode(F.arrays_zip(vector["indices"].alias("id"), vector["values"].alias("value"))).alias("c"))
        n = dataset.count()
        met = cells.where(F.col("c.value") > 0).groupBy(F.col("c.id").alias("id")).agg(F.count("*").alias("n"))
        weight = F.when(F.col("n") >= self.getMinDocFreq(), F.log((F.lit(n) + 1.0) / (F.col("n") + 1.0))).otherwise(0.0)
        unseen = math.log(n + 1) if self.getMinDocFreq() <= 0 else 0.0
        return TermIDFModel(materialise(met.withColumn("idf", weight)), unseen, source, self.getOutputCol())


class TermIDFModel(Model):
    """Sparse vectors times ``weights(id, n, idf)``; ``unseen`` is the weight of a term that no fitted row had."""

    def __init__(self, weights: DataFrame, unseen: float, source: str, to: str):
        super().__init__()
        self.weights, self.unseen, self.source, self.to = weights, unseen, source, to

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = _numbered(dataset)
        vector = F.unwrap_udt(self.source)
        cells = rows.select("_row", F.explode(F.arrays_zip(vector["indices"].alias("id"), vector["values"].alias("value"))).alias("c"))
        cells = cells.select("_row", F.col("c.id").alias("id"), F.col("c.value").alias("value"))
        joined = lookup_join(cells, self.weights.select("id", "idf"), "id", self.weights.select("id", "n"), "left")
        value = F.col("value") * F.coalesce("idf", F.lit(self.unseen))
        sized = rows.withColumn("_size", vector["size"])
        return _with_vectors(sized, joined.select("_row", "id", value.alias("value")), F.col("_size"), self.to).drop("_size")


def idf(source: str = "rawFeatures", to: str = "features") -> IDF:
    return TermIDF(inputCol=source, outputCol=to)


def label_indexer(source: str = "Feelings", to: str = "indexedLabel") -> StringIndexer:
    """Commonest label 0, ties alphabetical. Fit once, on training rows only."""
    return StringIndexer(inputCol=source, outputCol=to, stringOrderType="frequencyDesc")


def label_names(model: StringIndexerModel, source: str = "prediction", to: str = "predictedLabel") -> IndexToString:
    return IndexToString(inputCol=source, outputCol=to, labels=model.labels)


def vector_indexer(source: str = "rawFeatures", to: str = "indexedFeatures") -> VectorIndexer:
    return VectorIndexer(inputCol=source, outputCol=to, maxCategories=4, handleInvalid="keep")


def assembler(sources: Sequence[str], to: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(sources), outputCol=to)


def binarizer(threshold: float = 0.1, source: str = "features", to: str = "present") -> Binarizer:
    return Binarizer(threshold=threshold, inputCol=source, outputCol=to)


@contextmanager
def cached(*tables: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep tables that an iterative fit rereads; release them afterwards. Lost blocks are
    recomputed from their lineage."""
    kept = tuple(t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables)
    try:
        yield kept
    finally:
        for table in kept:
            table.unpersist()
