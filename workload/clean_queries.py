"""Text columns, the three cleaners, dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V
from verbatide.functions import text as T
from verbatide.operators import lexicon as L
from verbatide.operators import frequency
from workload import sql as S
from workload.tables import (
    Query,
    abbreviations,
    conversations,
    documents,
    exceptions,
    lexicon,
    pages,
    table,
)


def _on_pages(function):
    return lambda spark, d: pages(spark, d).select("page_id", function(F.col("html")).alias("ctext"))


def _on_documents(function):
    return lambda spark, d: documents(spark, d).select("doc_id", function(F.col("text")).alias("ctext"))


def _replaced(source: str, pattern: str, by: str) -> str:
    key, text = ("page_id", "html") if source == "pages" else ("doc_id", "text")
    return f"SELECT {key}, {S.replace(text, pattern, by)} AS ctext FROM {source}"


# Documents hold no emoji and few tags, so both are put around the whole text.
EMOJI_TEXT, EMOJI_SQL = ("😀 ", " ✂ 한 字 🇫🇷 ok"), "'😀 ' || text || ' ✂ 한 字 🇫🇷 ok'"


def _emoji_text():
    return F.concat(F.lit(EMOJI_TEXT[0]), F.col("text"), F.lit(EMOJI_TEXT[1]))


def _marked(spark, d):
    text = F.concat(F.lit("#"), F.col("source"), F.lit(" "), F.col("text"), F.lit(" @"), F.col("lang"), F.lit("19 #19wave"))
    return documents(spark, d, "source", "lang").select("doc_id", text.alias("text"))


MARKED = "marked AS (SELECT doc_id, '#' || source || ' ' || text || ' @' || lang || '19 #19wave' AS text FROM documents)"


def _on_marked(function):
    return lambda spark, d: _marked(spark, d).select("doc_id", function(F.col("text")).alias("ctext"))


def _marked_sql(expr: str) -> str:
    return f"WITH {MARKED} SELECT doc_id, {expr} AS ctext FROM marked"


def _tags(mark: str) -> str:
    return f"array_to_string(regexp_extract_all(text, '{mark}([{V.WORD}]+)', 1), ' ')"


def _b_blanked(expr: str) -> str:
    for pattern, by in (
        (V.HTTP_RUN, " "), (V.TAG_ON_ONE_LINE, " "), (V.DIGITS, " "), (V.HASHTAG, " "), (V.MENTION, " "),
        (V.NOT_WORD_OR_SPACE, ""),
    ):
        expr = S.replace(expr, pattern, by)
    return f"regexp_extract_all(lower({expr}), '[{V.WORD}]+')"


def clean_a(spark, d):
    return pages(spark, d).select("page_id", T.clean_a(F.col("html")).alias("ctext"))


def clean_b(spark, d):
    words = T.clean_b(F.col("html"))
    return pages(spark, d).select("page_id", T.join_words(words).alias("ctext"))


def clean_c(spark, d):
    return pages(spark, d).select("page_id", T.clean_c(F.col("html")).alias("ctext"))


def clean_b_lemmas(spark, d):
    rows = L.clean_b_table(documents(spark, d), "text", lexicon(spark, d), exceptions(spark, d))
    return rows.select("doc_id", T.join_words(F.col("words")).alias("ctext"))


CLEAN_B_LEMMAS_SQL = f"""
WITH {S.BENCH_WORDS}, {S.LEXICON}, {S.EXCEPTIONS},
lists AS (
  SELECT doc_id, list_filter({_b_blanked('text')}, lambda w: w NOT IN {S.CLEANER_STOP}) AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS place FROM lists),
vocabulary AS (SELECT DISTINCT token FROM words),
{S.lemma_ctes('vocabulary', 'v', True)},
joined AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY place) AS ctext
  FROM words LEFT JOIN lemmas USING (token) WHERE length(coalesce(lemma, token)) > 2 GROUP BY doc_id)
SELECT doc_id, coalesce(ctext, '') AS ctext FROM documents LEFT JOIN joined USING (doc_id)"""


def clean_c_tables(spark, d):
    rows = L.clean_c_table(documents(spark, d), "text", lexicon(spark, d), abbreviations(spark, d))
    return rows.select("doc_id", "ctext")


CLEAN_C_TABLES_SQL = f"""
WITH {S.ABBREVIATIONS}, {S.LEXICON},
lists AS (SELECT doc_id, {S.split(S.noise('text'))} AS w FROM documents),
raw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM lists),
words AS (
  SELECT doc_id, place, coalesce(expansion, word) AS token
  FROM raw LEFT JOIN abbreviations ON word = abbrev
  WHERE coalesce(expansion, word) NOT IN {S.CLEANER_STOP}),
vocabulary AS (SELECT DISTINCT token FROM words),
{S.lemma_ctes('vocabulary', 'n', False)},
joined AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY place) AS ctext
  FROM words LEFT JOIN lemmas USING (token) WHERE length(coalesce(lemma, token)) > 1 GROUP BY doc_id)
SELECT doc_id, coalesce(ctext, '') AS ctext FROM documents LEFT JOIN joined USING (doc_id)"""


def expand_abbrev(spark, d):
    rows = L.expand_abbreviations(documents(spark, d), "text", abbreviations(spark, d))
    return rows.select("doc_id", "ctext")


def _rough_entries(spark, d, words):
    """Entries with all that a dictionary may hold: no word, no replacement, several replacements."""
    first = F.substring("word", 1, 2)
    null = F.lit(None).cast("string")
    whole = words.select("word", F.when(F.length("word") % 5 != 0, F.concat(first, F.lit("-"))).alias("replacement"))
    twice = words.select("word", F.when(F.length("word") % 3 == 0, F.concat(F.lit("+"), "word")).alias("replacement"))
    return whole.unionByName(twice).unionByName(words.select(null.alias("word"), F.col("word").alias("replacement")))


def _rough_mapping(words_of):
    """Texts with null and repeated keys, through a dictionary of any size."""

    def run(spark, d):
        words = words_of(spark, d)
        rows = documents(spark, d)
        rows = rows.select(F.when(F.col("doc_id") % 3 != 0, F.floor(F.col("doc_id") / 2)).alias("key"), _plain_words().alias("words"))
        mapped = L.map_words(rows, "words", _rough_entries(spark, d, words))
        return mapped.select("key", T.join_words(F.col("words")).alias("ctext"))

    return run


def _words_of_items(spark, d):
    return frequency.explode_words(table(spark, d, "benchmark", "text"), _plain_words(), "word").distinct()


def _words_of_documents(spark, d):
    return frequency.explode_words(documents(spark, d), _plain_words(), "word").distinct()


def _rough_sql(source):
    return f"""
WITH words AS (SELECT DISTINCT unnest({S.plain('text')}) AS word FROM {source}),
entries AS (
  SELECT word, CASE WHEN length(word) % 5 <> 0 THEN substr(word, 1, 2) || '-' END AS replacement FROM words
  UNION ALL SELECT word, CASE WHEN length(word) % 3 = 0 THEN '+' || word END FROM words
  UNION ALL SELECT NULL, word FROM words),
best AS (SELECT word, min(replacement) AS replacement FROM entries WHERE word IS NOT NULL GROUP BY word),
lists AS (SELECT doc_id, {S.plain('text')} AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM lists),
joined AS (
  SELECT doc_id, string_agg(coalesce(replacement, word), ' ' ORDER BY place) AS ctext
  FROM placed LEFT JOIN best USING (word) GROUP BY doc_id)
SELECT CASE WHEN doc_id % 3 <> 0 THEN doc_id // 2 END AS key, coalesce(ctext, '') AS ctext
FROM documents LEFT JOIN joined USING (doc_id)"""


EXPAND_SQL = f"""
WITH {S.ABBREVIATIONS},
lists AS (SELECT doc_id, {S.split(S.noise('text'))} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM lists),
joined AS (
  SELECT doc_id, string_agg(coalesce(expansion, word), ' ' ORDER BY place) AS ctext
  FROM words LEFT JOIN abbreviations ON word = abbrev GROUP BY doc_id)
SELECT doc_id, coalesce(ctext, '') AS ctext FROM documents LEFT JOIN joined USING (doc_id)"""


def _plain_words():
    return T.split_words(T.strip_punctuation(F.lower(F.col("text"))))


def lemma_join(spark, d):
    rows = documents(spark, d).select("doc_id", _plain_words().alias("words"))
    lemmas = L.lemmatise(rows, "words", lexicon(spark, d), "v", exceptions(spark, d))
    return lemmas.select("doc_id", T.join_words(F.col("words")).alias("lemmas"))


LEMMA_JOIN_SQL = f"""
WITH {S.BENCH_WORDS}, {S.LEXICON}, {S.EXCEPTIONS},
lists AS (SELECT doc_id, {S.plain('text')} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS place FROM lists),
vocabulary AS (SELECT DISTINCT token FROM words),
{S.lemma_ctes('vocabulary', 'v', True)},
joined AS (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY place) AS lemmas
  FROM words LEFT JOIN lemmas USING (token) GROUP BY doc_id)
SELECT doc_id, coalesce(lemmas, '') AS lemmas FROM documents LEFT JOIN joined USING (doc_id)"""


def lemma_counts(spark, d):
    counts = frequency.term_counts(documents(spark, d), _plain_words())
    return L.lemma_counts(counts, lexicon(spark, d), "n")


LEMMA_COUNTS_SQL = f"""
WITH {S.LEXICON},
words AS (SELECT unnest({S.plain('text')}) AS token FROM documents),
vocabulary AS (SELECT DISTINCT token FROM words),
{S.lemma_ctes('vocabulary', 'n', False)}
SELECT coalesce(lemma, token) AS lemma, count(*) AS n FROM words LEFT JOIN lemmas USING (token)
GROUP BY coalesce(lemma, token)"""


def pos_join(spark, d):
    """The commonest language of each document word as its tag, applied to the conversations."""
    seen = frequency.explode_words(documents(spark, d, "lang"), _plain_words(), "token", "lang")
    tags = L.most_frequent_tags(L.tag_table(seen.withColumnRenamed("lang", "tag")))
    rows = conversations(spark, d).select("turn_id", _plain_words().alias("words"))
    tagged = L.tag_words(rows, "words", tags)
    return tagged.select("turn_id", T.join_words(F.col("pos")).alias("pos"))


TAGS_SQL = f"""
seen AS (SELECT lang AS tag, unnest({S.plain('text')}) AS token FROM documents),
tags AS (
  SELECT token, tag FROM (
    SELECT token, tag, row_number() OVER (PARTITION BY token ORDER BY count(*) DESC, tag) AS r
    FROM seen GROUP BY token, tag) WHERE r = 1)"""

POS_SQL = f"""
WITH {TAGS_SQL},
turns AS (SELECT conv_id || '-' || turn AS turn_id, {S.plain('text')} AS w FROM conversations),
words AS (SELECT turn_id, unnest(w) AS token, unnest(range(len(w))) AS place FROM turns),
joined AS (
  SELECT turn_id, string_agg(coalesce(tag, 'NN'), ' ' ORDER BY place) AS pos
  FROM words LEFT JOIN tags USING (token) GROUP BY turn_id)
SELECT turn_id, coalesce(pos, '') AS pos FROM turns LEFT JOIN joined USING (turn_id)"""


def tag_fit(spark, d):
    seen = frequency.explode_words(documents(spark, d, "lang"), _plain_words(), "token", "lang")
    return L.most_frequent_tags(L.tag_table(seen.withColumnRenamed("lang", "tag")))


def tag_table(spark, d):
    talk = table(spark, d, "conversations", "role", "text")
    seen = frequency.explode_words(talk, _plain_words(), "token", "role")
    return L.tag_table(seen.withColumnRenamed("role", "tag"))


def stopword_filter(spark, d):
    words = T.remove_words(_plain_words(), V.STOP_WORDS)
    return documents(spark, d).select("doc_id", T.join_words(words).alias("ctext"))


def min_length(spark, d):
    words = T.keep_longer_than(_plain_words(), 2)
    return documents(spark, d).select("doc_id", T.join_words(words).alias("ctext"))


QUERIES = {
    "lower_case": Query(_on_documents(F.lower), "SELECT doc_id, lower(text) AS ctext FROM documents"),
    "strip_urls": Query(_on_pages(T.strip_urls), _replaced("pages", V.URL, "")),
    "blank_urls": Query(_on_pages(T.blank_urls), _replaced("pages", V.HTTP_RUN, " ")),
    "strip_html": Query(_on_pages(T.strip_markup), _replaced("pages", V.TAG, "")),
    "blank_html": Query(_on_pages(T.blank_markup), _replaced("pages", V.TAG_ON_ONE_LINE, " ")),
    "strip_emoji": Query(
        lambda spark, d: documents(spark, d).select("doc_id", T.strip_emoji(_emoji_text()).alias("ctext")),
        f"SELECT doc_id, {S.replace(EMOJI_SQL, V.EMOJI, '')} AS ctext FROM documents",
    ),
    "strip_emoji_narrow": Query(
        lambda spark, d: documents(spark, d).select("doc_id", T.strip_emoji(_emoji_text(), narrow=True).alias("ctext")),
        f"SELECT doc_id, {S.replace(EMOJI_SQL, V.EMOJI_NARROW, '')} AS ctext FROM documents",
    ),
    "strip_punct": Query(_on_documents(T.strip_punctuation), _replaced("documents", V.ASCII_PUNCTUATION, "")),
    "strip_symbols": Query(_on_pages(T.strip_symbols), _replaced("pages", V.NOT_WORD_OR_SPACE, "")),
    "blank_digits": Query(_on_pages(T.blank_digits), _replaced("pages", V.DIGITS, " ")),
    "blank_hashtags": Query(_on_marked(T.blank_hashtags), _marked_sql(S.replace("text", V.HASHTAG, " "))),
    "blank_mentions": Query(_on_marked(T.blank_mentions), _marked_sql(S.replace("text", V.MENTION, " "))),
    "hashtags": Query(_on_marked(T.hashtags), _marked_sql(_tags("#"))),
    "mentions": Query(_on_marked(T.mentions), _marked_sql(_tags("@"))),
    "split_join": Query(
        lambda spark, d: documents(spark, d).select("doc_id", T.join_words(T.split_words(F.col("text"))).alias("ctext")),
        f"SELECT doc_id, array_to_string({S.split('text')}, ' ') AS ctext FROM documents",
    ),
    "word_tokens": Query(
        lambda spark, d: pages(spark, d).select("page_id", T.join_words(T.word_tokens(F.col("html"))).alias("ctext")),
        f"SELECT page_id, array_to_string(regexp_extract_all(html, '{V.WORDS}'), ' ') AS ctext FROM pages",
    ),
    "raw_tokens": Query(
        lambda spark, d: pages(spark, d).select("page_id", T.join_words(T.raw_tokens(F.col("html"))).alias("ctext")),
        f"SELECT page_id, array_to_string(regexp_extract_all(html, '{V.WORDS_OR_MARKS}'), ' ') AS ctext FROM pages",
    ),
    "stopword_filter": Query(
        stopword_filter,
        f"""SELECT doc_id, array_to_string(list_filter({S.plain('text')}, lambda w: w NOT IN {S.CLEANER_STOP}), ' ')
            AS ctext FROM documents""",
    ),
    "min_length": Query(
        min_length,
        f"""SELECT doc_id, array_to_string(list_filter({S.plain('text')}, lambda w: length(w) > 2), ' ') AS ctext
            FROM documents""",
    ),
    "clean_a": Query(
        clean_a, f"SELECT page_id, trim(array_to_string({S.split(S.noise('html'))}, ' ')) AS ctext FROM pages"
    ),
    "clean_b": Query(
        clean_b,
        f"""SELECT page_id, array_to_string(list_filter({_b_blanked('html')},
              lambda w: w NOT IN {S.CLEANER_STOP} AND length(w) > 2), ' ') AS ctext FROM pages""",
    ),
    "clean_b_lemmas": Query(clean_b_lemmas, CLEAN_B_LEMMAS_SQL),
    "clean_c": Query(
        clean_c,
        f"""SELECT page_id, array_to_string(list_filter({S.split(S.noise('html'))},
              lambda w: w NOT IN {S.CLEANER_STOP} AND length(w) > 1), ' ') AS ctext FROM pages""",
    ),
    "clean_c_tables": Query(clean_c_tables, CLEAN_C_TABLES_SQL),
    "expand_abbrev": Query(expand_abbrev, EXPAND_SQL),
    "rough_dictionary_short": Query(_rough_mapping(_words_of_items), _rough_sql("benchmark")),
    "rough_dictionary_long": Query(_rough_mapping(_words_of_documents), _rough_sql("documents")),
    "lemma_join": Query(lemma_join, LEMMA_JOIN_SQL),
    "lemma_counts": Query(lemma_counts, LEMMA_COUNTS_SQL),
    "tag_table": Query(
        tag_table,
        f"""SELECT token, role AS tag, count(*) AS n
            FROM (SELECT role, unnest({S.plain('text')}) AS token FROM conversations) GROUP BY token, role""",
    ),
    "tag_fit": Query(tag_fit, f"WITH {TAGS_SQL} SELECT token, tag FROM tags"),
    "pos_join": Query(pos_join, POS_SQL),
}
