"""Term tables, sequences and ML feature stages."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from verbatide.functions import text as T
from verbatide.operators import features as X
from verbatide.operators import frequency
from verbatide.plans.explore import content_words
from workload import sql as S
from workload.tables import Query, classed, conversations, documents, labelled, table


def _words():
    return content_words(F.col("text"))


def _tf(spark, d):
    return X.term_frequencies(documents(spark, d), "doc_id", _words())


def _documents_count(spark, d):
    return table(spark, d, "documents", "doc_id").agg(F.count("*")).scalar()


TF = f"""words AS (SELECT doc_id, unnest({S.content('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"""
N = "(SELECT count(*) FROM documents)"
TFIDF = f"""{TF},
raw AS (SELECT doc_id, term, tf, tf * (ln(({N} + 1) / (df + 1)) + 1) AS w FROM tf JOIN df USING (term)),
tfidf AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM raw)"""


def count_vectors(spark, d):
    """Count vectors as triples, over all words of two or more letters."""
    return X.term_frequencies(documents(spark, d), "doc_id", T.count_tokens(F.col("text")))


def tfidf(spark, d):
    weights = X.tfidf(_tf(spark, d), "doc_id", _documents_count(spark, d))
    return weights.withColumn("tfidf", F.round("tfidf", 6))


def idf(spark, d):
    return X.idf_table(_tf(spark, d), _documents_count(spark, d)).withColumn("idf", F.round("idf", 6))


def binarise(spark, d):
    weights = X.tfidf(_tf(spark, d), "doc_id", _documents_count(spark, d))
    present = X.binarise(weights.select("doc_id", F.round("tfidf", 9).alias("present")), "present", 0.1)
    return present.groupBy("doc_id").agg(F.sum("present").alias("present"), F.count("*").alias("terms"))


def _index(spark, d):
    return X.word_index(frequency.term_counts(documents(spark, d), _words(), "word"))


INDEX = f"""counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({S.content('text')}) AS word FROM documents) GROUP BY word),
word_index AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS id FROM counts)"""


def _sequences(spark, d):
    return X.word_sequences(conversations(spark, d), "turn_id", _words(), _index(spark, d))


def _text(sequence):
    return F.array_join(F.transform(sequence, lambda x: x.cast("string")), " ")


def sequences(spark, d):
    return _sequences(spark, d).select("turn_id", _text(F.col("sequence")).alias("sequence"))


def pad_sequences(spark, d):
    return _sequences(spark, d).select("turn_id", _text(X.pad(F.col("sequence"), 50)).alias("padded"))


SEQUENCES = f"""{INDEX},
turns AS (SELECT conv_id || '-' || turn AS turn_id, {S.content('text')} AS w FROM conversations),
placed AS (SELECT turn_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM turns),
lists AS (SELECT turn_id, list(id ORDER BY place) AS ids FROM placed JOIN word_index USING (word) GROUP BY turn_id),
sequences AS (SELECT turn_id, coalesce(ids, []) AS ids FROM turns LEFT JOIN lists USING (turn_id))"""


def tokenizer(spark, d):
    """The ML stage keeps empty words; the native form drops them."""
    rows = X.tokenizer("text", "words").transform(documents(spark, d))
    dropped = X.lower_tokens(F.col("text"))
    return rows.select(
        "doc_id", T.word_count(F.col("words")).alias("with_empty"), T.word_count(dropped).alias("without_empty")
    )


def regex_tokenizer(spark, d):
    rows = X.regex_tokenizer("text", "words").transform(documents(spark, d))
    return rows.select("doc_id", T.join_words(F.col("words")).alias("words"))


def stop_remover(spark, d):
    rows = documents(spark, d).select("doc_id", T.raw_tokens(F.col("text")).alias("lemmas"))
    rows = X.stop_remover().transform(rows)
    return rows.select("doc_id", T.join_words(F.col("filtered_lemmas")).alias("filtered_lemmas"))


def stop_words_native(spark, d):
    words = X.without_stop_words(T.raw_tokens(F.col("text")))
    return documents(spark, d).select("doc_id", T.join_words(words).alias("filtered_lemmas"))


STOP_SQL = f"""SELECT doc_id, array_to_string(list_filter(
  regexp_extract_all(text, '{S.V.WORDS_OR_MARKS}'), lambda w: lower(w) NOT IN {S.STOP}), ' ') AS filtered_lemmas
FROM documents"""


def _ngrams(n):
    def run(spark, d):
        rows = documents(spark, d).select("doc_id", _words().alias("words"))
        rows = X.ngram(n).transform(rows)
        return rows.select("doc_id", F.array_join("ngrams", "|").alias("ngrams"))

    return run


def _ngrams_sql(n):
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return f"""
WITH lists AS (SELECT doc_id, {S.content('text')} AS w FROM documents),
grams AS (SELECT doc_id, i, {gram} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM lists)),
joined AS (SELECT doc_id, string_agg(g, '|' ORDER BY i) AS ngrams FROM grams GROUP BY doc_id)
SELECT doc_id, coalesce(ngrams, '') AS ngrams FROM documents LEFT JOIN joined USING (doc_id)"""


def ngrams_native(spark, d):
    rows = conversations(spark, d).select("turn_id", _words().alias("words"))
    return rows.select("turn_id", F.array_join(T.ngrams(F.col("words"), 3), "|").alias("ngrams"))


NGRAMS_NATIVE_SQL = f"""
WITH turns AS (SELECT conv_id || '-' || turn AS turn_id, {S.content('text')} AS w FROM conversations)
SELECT turn_id, coalesce(list_aggregate(list_transform(range(1, greatest(len(w) - 1, 1)),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]), 'string_agg', '|'), '') AS ngrams FROM turns"""


def hashing_tf(spark, d):
    """Which bucket a word falls into is Spark's affair; a row's total is its number of words."""
    rows = documents(spark, d).select("doc_id", _words().alias("words"))
    vectors = X.hashing_tf(2000).transform(rows)
    return vectors.select("doc_id", X.vector_total("rawFeatures").alias("total"))


def label_index(spark, d):
    rows = classed(spark, d).select("doc_id", "Sentiments")
    model = X.label_indexer("Sentiments").fit(rows)
    indexed = model.transform(rows)
    named = X.label_names(model, "indexedLabel").transform(indexed)
    return named.select("doc_id", "Sentiments", "indexedLabel", "predictedLabel")


def assemble(spark, d):
    """Two numbers as a vector, of which the one with few values is recoded by the vector indexer."""
    status = F.when(F.col("o_orderstatus") == "F", 10).when(F.col("o_orderstatus") == "O", 20).otherwise(30)
    priority = F.substring("o_orderpriority", 1, 1).cast("double")
    rows = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = rows.select("o_orderkey", status.cast("double").alias("status"), priority.alias("priority"))
    vectors = X.assembler(["status", "priority"], "rawFeatures").transform(rows)
    indexed = X.vector_indexer().fit(vectors).transform(vectors)
    parts = vector_to_array("indexedFeatures")
    return indexed.select("o_orderkey", parts[0].alias("status_index"), parts[1].alias("priority"))


def vectors_binarised(spark, d):
    rows = table(spark, d, "embeddings", "vec_id", "embedding")
    vectors = rows.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    present = X.binarizer().transform(vectors)
    total = F.aggregate(vector_to_array("present"), F.lit(0.0), lambda a, b: a + b)
    return present.select("vec_id", total.alias("present"))


def tfidf_apply(spark, d):
    """Fitted on the labelled documents, applied to all."""
    train = labelled(spark, d)
    fitted = X.TfIdf.fit(X.term_frequencies(train, "doc_id", _words()), train.count())
    weights = fitted.apply(_tf(spark, d), "doc_id")
    return weights.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


FITTED = f"""{S.LABELLED},
words AS (SELECT doc_id, unnest({S.content('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf WHERE doc_id IN (SELECT doc_id FROM labelled) GROUP BY term),
raw AS (
  SELECT doc_id, term, tf, tf * (ln(((SELECT count(*) FROM labelled) + 1) / (df + 1)) + 1) AS w
  FROM tf JOIN df USING (term)),
weighted AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM raw)"""


def idf_stage(spark, d):
    """Counts of all terms weighted by the ML stage."""
    rows = documents(spark, d).select("doc_id", _words().alias("words"))
    vectors = X.count_vectorizer(X.vocabulary(rows, F.col("words"))).transform(rows).select("doc_id", "rawFeatures")
    weighted = X.idf().fit(vectors).transform(vectors)
    return weighted.select("doc_id", F.round(X.vector_total("features"), 6).alias("total"))


QUERIES = {
    "tf_triples": Query(_tf, f"WITH {TF} SELECT doc_id, term, tf FROM tf"),
    "count_vectors": Query(
        count_vectors,
        f"""SELECT doc_id, term, count(*) AS tf FROM (
              SELECT doc_id, unnest(regexp_extract_all(lower(text), '{S.V.LONG_WORDS}')) AS term FROM documents)
            GROUP BY doc_id, term""",
    ),
    "document_frequencies": Query(
        lambda spark, d: X.document_frequencies(_tf(spark, d)), f"WITH {TF} SELECT term, df FROM df"
    ),
    "idf": Query(idf, f"WITH {TF} SELECT term, df, round(ln(({N} + 1) / (df + 1)), 6) AS idf FROM df"),
    "idf_stage": Query(
        idf_stage,
        f"""WITH {TF}
            SELECT doc_id, round(coalesce(sum(tf * ln(({N} + 1) / (df + 1))), 0), 6) AS total
            FROM documents LEFT JOIN tf USING (doc_id) LEFT JOIN df USING (term) GROUP BY doc_id""",
    ),
    "tfidf_apply": Query(
        tfidf_apply, f"WITH {FITTED} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM weighted"
    ),
    "tfidf_l2": Query(tfidf, f"WITH {TFIDF} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM tfidf"),
    "binarise": Query(
        binarise,
        f"""WITH {TFIDF} SELECT doc_id, sum(CASE WHEN round(tfidf, 9) > 0.1 THEN 1.0::DOUBLE ELSE 0.0 END) AS present,
            count(*) AS terms FROM tfidf GROUP BY doc_id""",
    ),
    "word_index": Query(_index, f"WITH {INDEX} SELECT word, n, id FROM word_index"),
    "text_to_seq": Query(
        sequences, f"WITH {SEQUENCES} SELECT turn_id, array_to_string(ids, ' ') AS sequence FROM sequences"
    ),
    "pad_seq": Query(
        pad_sequences,
        f"""WITH {SEQUENCES},
            cut AS (SELECT turn_id, CASE WHEN len(ids) > 50 THEN ids[len(ids) - 49:] ELSE ids END AS ids FROM sequences)
            SELECT turn_id, array_to_string(list_concat(ids, list_transform(range(50 - len(ids)), lambda i: 0)), ' ')
              AS padded FROM cut""",
    ),
    "tokenizer": Query(
        tokenizer,
        """WITH lists AS (
             SELECT doc_id, regexp_split_to_array(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', ''), '[ \\t\\n\\x0B\\f\\r]') AS w
             FROM documents)
           SELECT doc_id, len(w) AS with_empty, len(list_filter(w, lambda x: x <> '')) AS without_empty FROM lists""",
    ),
    "regex_tokenizer": Query(
        regex_tokenizer,
        """SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z_0-9]'),
             lambda w: w <> ''), ' ') AS words FROM documents""",
    ),
    "stop_remover": Query(stop_remover, STOP_SQL),
    "stop_words_native": Query(stop_words_native, STOP_SQL),
    "bigrams": Query(_ngrams(2), _ngrams_sql(2)),
    "trigrams": Query(_ngrams(3), _ngrams_sql(3)),
    "trigrams_native": Query(ngrams_native, NGRAMS_NATIVE_SQL),
    "hashing_tf": Query(hashing_tf, f"SELECT doc_id, len({S.content('text')})::DOUBLE AS total FROM documents"),
    "label_index": Query(
        label_index,
        f"""WITH {S.CLASSED},
            ranks AS (
              SELECT Sentiments, (row_number() OVER (ORDER BY count(*) DESC, Sentiments) - 1)::DOUBLE AS indexedLabel
              FROM classed GROUP BY Sentiments)
            SELECT doc_id, Sentiments, indexedLabel, Sentiments AS predictedLabel FROM classed JOIN ranks USING (Sentiments)""",
    ),
    "assemble_and_index": Query(
        assemble,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0 ELSE 2.0 END AS status_index,
                  substr(o_orderpriority, 1, 1)::DOUBLE AS priority FROM orders""",
    ),
    "binarizer_stage": Query(
        vectors_binarised,
        """SELECT vec_id, len(list_filter(embedding, lambda x: x::DOUBLE > 0.1))::DOUBLE AS present FROM embeddings""",
    ),
}
