"""Counts of words, n-grams, tags and lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V
from verbatide.functions import text as T
from verbatide.operators import frequency
from verbatide.plans import explore
from workload import sql as S
from workload.tables import Query, classed, conversations, documents


def _plain(column="text"):
    return T.split_words(T.strip_punctuation(F.lower(F.col(column))))


def _tagged(spark, d):
    """Documents with their source as a hashtag and, for some, their language as a mention."""
    mention = F.when(F.col("lang") != "en", F.concat(F.lit(" @"), F.col("lang"))).otherwise("")
    text = F.concat(F.lit("#"), F.col("source"), F.lit(" "), F.col("text"), mention)
    return documents(spark, d, "source", "lang").select("doc_id", text.alias("text"))


TAGGED = """tagged AS (
  SELECT doc_id, '#' || source || ' ' || text || CASE WHEN lang <> 'en' THEN ' @' || lang ELSE '' END AS text
  FROM documents)"""


def _tags(mark: str) -> str:
    return f"regexp_extract_all(text, '{mark}([{V.WORD}]+)', 1)"


def two_corpora(spark, d):
    """Words of both corpora under their names."""
    both = documents(spark, d).select(F.lit("documents").alias("corpus"), "text").unionByName(
        conversations(spark, d).select(F.lit("conversations").alias("corpus"), "text")
    )
    counts = frequency.term_counts(both, _plain(), "token", ["corpus"])
    return counts.groupBy("corpus").agg(F.sum("n").alias("words"), F.count("*").alias("terms"))


def _histogram_sql(measure: str) -> str:
    return f"""
WITH {S.CLASSED}, measured AS (SELECT Sentiments, {measure} AS x FROM classed),
ranges AS (
  SELECT Sentiments, CASE WHEN min(x) = max(x) THEN min(x) - 0.5::DOUBLE ELSE min(x) END::DOUBLE AS lo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5::DOUBLE ELSE max(x) END::DOUBLE AS hi
  FROM measured GROUP BY Sentiments),
placed AS (
  SELECT Sentiments, least(floor((x - lo) * 10 / (hi - lo)) + 1, 10)::BIGINT AS bin
  FROM measured JOIN ranges USING (Sentiments))
SELECT r.Sentiments, b.bin, round(lo + (b.bin - 1) * (hi - lo) / 10, 6) AS bin_from,
       round(lo + b.bin * (hi - lo) / 10, 6) AS bin_to,
       (SELECT count(*) FROM placed p WHERE p.Sentiments = r.Sentiments AND p.bin = b.bin) AS n
FROM ranges r, (SELECT unnest(range(1, 11)) AS bin) b"""


def _histogram(spark, d, measure):
    rows = frequency.histogram(classed(spark, d), "Sentiments", measure)
    return rows.select("Sentiments", "bin", F.round("bin_from", 6).alias("bin_from"), F.round("bin_to", 6).alias("bin_to"), "n")


def _ngram_sql(n: int, k: int) -> str:
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return f"""
WITH lists AS (SELECT {S.content('text')} AS w FROM documents),
grams AS (SELECT {gram} AS ngram FROM (SELECT w, unnest(range(1, len(w) - {n - 2})) AS i FROM lists))
SELECT ngram, count(*) AS n FROM grams GROUP BY ngram ORDER BY n DESC, ngram LIMIT {k}"""


CLASS_WORDS = f"class_words AS (SELECT Sentiments, unnest({S.plain('text')}) AS word FROM classed)"

QUERIES = {
    "class_distribution": Query(
        lambda spark, d: frequency.class_distribution(classed(spark, d), "Sentiments"),
        f"WITH {S.CLASSED} SELECT Sentiments, count(*) AS n FROM classed GROUP BY Sentiments",
    ),
    "term_topk": Query(
        lambda spark, d: explore.top_words(documents(spark, d), "text", 20),
        f"""WITH words AS (SELECT unnest({S.plain('text')}) AS token FROM documents)
            SELECT token, count(*) AS n FROM words WHERE token NOT IN {S.STOP}
            GROUP BY token ORDER BY n DESC, token LIMIT 20""",
    ),
    "term_counts": Query(
        lambda spark, d: frequency.term_counts(documents(spark, d), _plain()),
        f"""WITH words AS (SELECT unnest({S.plain('text')}) AS token FROM documents)
            SELECT token, count(*) AS n FROM words GROUP BY token""",
    ),
    "vocab_size": Query(
        lambda spark, d: frequency.vocabulary_size(documents(spark, d), _plain()),
        f"SELECT count(DISTINCT token) AS terms FROM (SELECT unnest({S.plain('text')}) AS token FROM documents)",
    ),
    "two_corpora": Query(
        two_corpora,
        f"""WITH words AS (
              SELECT 'documents' AS corpus, unnest({S.plain('text')}) AS token FROM documents
              UNION ALL SELECT 'conversations', unnest({S.plain('text')}) FROM conversations)
            SELECT corpus, count(*) AS words, count(DISTINCT token) AS terms FROM words GROUP BY corpus""",
    ),
    "bigram_topk": Query(lambda spark, d: explore.top_ngrams(documents(spark, d), "text", 2), _ngram_sql(2, 10)),
    "trigram_topk": Query(lambda spark, d: explore.top_ngrams(documents(spark, d), "text", 3), _ngram_sql(3, 10)),
    "trigram_counts": Query(
        lambda spark, d: frequency.ngram_counts(documents(spark, d), explore.content_words(F.col("text")), 3),
        _ngram_sql(3, 0).rpartition("ORDER BY")[0],
    ),
    "class_corpus": Query(
        lambda spark, d: frequency.class_corpus(classed(spark, d), "Sentiments", "Positive", _plain()),
        f"WITH {S.CLASSED}, {CLASS_WORDS} SELECT word FROM class_words WHERE Sentiments = 'Positive'",
    ),
    "common_words_per_class": Query(
        lambda spark, d: frequency.common_words(classed(spark, d), "Sentiments", _plain(), V.STOP_WORDS),
        f"""WITH {S.CLASSED}, {CLASS_WORDS},
            ranked AS (
              SELECT Sentiments, word, count(*) AS n,
                     row_number() OVER (PARTITION BY Sentiments ORDER BY count(*) DESC, word) AS r
              FROM class_words GROUP BY Sentiments, word)
            SELECT Sentiments, word, n FROM ranked WHERE r <= 40 AND word NOT IN {S.CLEANER_STOP}""",
    ),
    "term_weights": Query(
        lambda spark, d: frequency.term_weights(classed(spark, d), "Sentiments", _plain(), V.STOP_WORDS).withColumn(
            "weight", F.round("weight", 6)
        ),
        f"""WITH {S.CLASSED}, {CLASS_WORDS},
            ranked AS (
              SELECT Sentiments, word, count(*) AS n,
                     row_number() OVER (PARTITION BY Sentiments ORDER BY count(*) DESC, word) AS r,
                     max(count(*)) OVER (PARTITION BY Sentiments) AS top
              FROM class_words WHERE word NOT IN {S.CLEANER_STOP} GROUP BY Sentiments, word)
            SELECT Sentiments, word, n, round(n / top, 6) AS weight FROM ranked WHERE r <= 200""",
    ),
    "tag_rank_slice": Query(
        lambda spark, d: frequency.popular_tags(_tagged(spark, d), T.hashtag_list(F.col("text"))),
        f"""WITH {TAGGED} SELECT array_to_string({_tags('#')}, ' ') AS tag, count(*) AS n
            FROM tagged GROUP BY tag ORDER BY n DESC, tag LIMIT 9 OFFSET 1""",
    ),
    "tag_rank_slice_per_tag": Query(
        lambda spark, d: frequency.popular_tags(_tagged(spark, d), T.hashtag_list(F.col("text")), 1, 10, per_tag=True),
        f"""WITH {TAGGED} SELECT tag, count(*) AS n FROM (SELECT unnest({_tags('#')}) AS tag FROM tagged)
            GROUP BY tag ORDER BY n DESC, tag LIMIT 10""",
    ),
    "mention_rank_slice": Query(
        lambda spark, d: frequency.popular_tags(_tagged(spark, d), T.mention_list(F.col("text"))),
        f"""WITH {TAGGED} SELECT array_to_string({_tags('@')}, ' ') AS tag, count(*) AS n
            FROM tagged GROUP BY tag ORDER BY n DESC, tag LIMIT 9 OFFSET 1""",
    ),
    "charlen_hist": Query(
        lambda spark, d: _histogram(spark, d, F.length("text")), _histogram_sql("length(text)")
    ),
    "wordcount_hist": Query(
        lambda spark, d: _histogram(spark, d, T.word_count(T.split_words(F.col("text")))),
        _histogram_sql(f"len({S.split('text')})"),
    ),
    "longest_text": Query(
        lambda spark, d: frequency.longest(documents(spark, d), F.col("text")),
        "SELECT max(length(text)) AS max_length FROM documents",
    ),
    "token_count": Query(
        lambda spark, d: documents(spark, d).select("doc_id", T.word_count(_plain()).alias("tokens")),
        f"SELECT doc_id, len({S.plain('text')}) AS tokens FROM documents",
    ),
}
