"""Dictionary work: abbreviations, lemmas and tags by joins with word tables.

Dictionaries are input tables of any size. Entries go to the word lists, not words to the entries: all entries if they
are few, else those of the commonest words; only the rest of the words is joined to the dictionary by shuffle and put
back in place, in time that grows with a text's length and not with its square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V
from verbatide.functions import text as T
from verbatide.operators.skew import COMMON, common_entries, lookup_join
from verbatide.session import materialise


def _present(words: str) -> Column:
    return F.coalesce(F.col(words), F.array().cast("array<string>"))


def _held(df: DataFrame, words: str) -> DataFrame:
    """``df`` written once, with a row number; a missing word list becomes an empty one."""
    return materialise(df.withColumns({words: _present(words), "_row": F.monotonically_increasing_id()}))


def _vocabulary(held: DataFrame, words: str) -> DataFrame:
    """(word, n): each distinct word and its occurrences."""
    return held.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _entries(mapping: DataFrame) -> DataFrame:
    """(word, replacement), one row for every word of ``mapping`` that has a replacement. Written: it is read for its
    size and for its rows."""
    entries = mapping.where(F.col("word").isNotNull() & F.col("replacement").isNotNull())
    return materialise(entries.groupBy("word").agg(F.min("replacement").alias("replacement")))


def _near(entries: DataFrame) -> pa.Table | None:
    """All ``entries``, if they are few enough to go to every task."""
    near = entries.select("word", "replacement").limit(COMMON + 1).toArrow()
    return near if near.num_rows <= COMMON else None


def _replaced(near: pa.Table, default: str | None) -> Callable[..., Column]:
    """A function of a list column: its words replaced by those of ``near(word, replacement)``, other words kept or
    ``default``. It also takes a column with a list of (_at, word) per row: the words of these places."""
    keys, values, bounds = near["word"].combine_chunks(), near["replacement"].combine_chunks(), _bounds_of()

    def mapped(words: pa.Array) -> pa.Array:
        found = pc.take(values, pc.index_in(words, keys.cast(words.type))).cast(words.type)
        return pc.coalesce(found, words if default is None else pa.scalar(default, words.type))

    @F.arrow_udf("array<string>")
    def whole(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in lists:
            yield pa.ListArray.from_arrays(bounds(some), mapped(some.flatten()))

    @F.arrow_udf("array<string>")
    def placed(lists: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for some, new in lists:
            words, rows, starts = some.flatten(), new.flatten(), bounds(some)
            row = np.repeat(np.arange(len(new)), np.diff(bounds(new)))
            source = np.arange(len(words))
            source[starts.to_numpy()[row] + pc.struct_field(rows, "_at").to_numpy()] = len(words) + np.arange(len(rows))
            both = pa.concat_arrays([mapped(words), pc.struct_field(rows, "word").cast(words.type)])
            yield pa.ListArray.from_arrays(starts, both.take(pa.array(source)))

    return lambda words, new=None: whole(words) if new is None else placed(words, new)


def _bounds_of() -> Callable[[pa.Array], pa.Array]:
    """A function that tells where each list begins in the flattened array, and the end of the last; a missing list is
    empty. It goes to the tasks by value, like the functions that use it."""

    def bounds(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        return pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32())

    return bounds


def _others(known: pa.Table) -> Callable[[Column], Column]:
    """A function of a list column: (_at, word) of its words that are not in ``known``."""
    keys, bounds = known["word"].combine_chunks(), _bounds_of()

    @F.arrow_udf("array<struct<_at:int,word:string>>")
    def others(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in lists:
            words, starts = some.flatten(), bounds(some).to_numpy()
            far = pc.and_(pc.invert(pc.is_in(words, keys.cast(words.type))), words.is_valid()).to_numpy(zero_copy_only=False)
            at = (np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts)))[far]
            rows = pa.StructArray.from_arrays([pa.array(at, pa.int32()), words.filter(pa.array(far))], ["_at", "word"])
            sums = np.concatenate([[0], np.cumsum(far)])
            yield pa.ListArray.from_arrays(pa.array(sums[starts], pa.int32()), rows)

    return others


def _replace(held: DataFrame, words: str, counts: DataFrame, entries: DataFrame, default: str | None) -> DataFrame:
    """Words are looked up where their list lies: in all entries if they are few, else in those of the commonest words of
    ``counts``. Only other words are looked up by shuffle, a row for each, and come back to their places."""
    near = _near(entries)
    if near is not None:
        return held.withColumn(words, _replaced(near, default)(F.col(words))).drop("_row")
    counts = materialise(counts)
    common = common_entries(entries, "word", counts, COMMON).select("word", "replacement").toArrow()
    rare = counts.join(F.broadcast(held.sparkSession.createDataFrame(common.select(["word"]))), "word", "left_anti")
    far = held.select("_row", F.inline(_others(common)(F.col(words))))
    found = lookup_join(far, entries, "word", rare).groupBy("_row")
    joined = held.join(found.agg(F.collect_list(F.struct("_at", F.col("replacement").alias("word"))).alias("_new")), "_row", "left")
    return joined.withColumn(words, _replaced(common, default)(F.col(words), F.col("_new"))).drop("_row", "_new")


def map_words(df: DataFrame, words: str, mapping: DataFrame, default: str | None = None) -> DataFrame:
    """Replace the words of the list column ``words`` by ``mapping(word, replacement)``.

    Words outside the mapping stay, or become ``default``, and so do words whose replacement is
    missing; entries without a word are ignored; of several replacements of a word the smallest counts. All rows
    stay, repeated ones too; a missing list becomes an empty one.
    """
    entries = _entries(mapping)
    near = _near(entries)
    if near is not None:
        return df.withColumn(words, _replaced(near, default)(_present(words)))
    held = _held(df, words)
    return _replace(held, words, _vocabulary(held, words), entries, default).select(*df.columns)


def expand_abbreviations(df: DataFrame, text: str, dictionary: DataFrame) -> DataFrame:
    """Add ``ctext``: cleaner A's text, with ``dictionary(abbrev, expansion)`` expanded.

    Lookup comes after lower-casing and punctuation removal, is by whole word, and expansions are
    not expanded again.
    """
    words = df.withColumn("_words", T.split_words(T.strip_noise(F.col(text))))
    pairs = dictionary.select(F.col("abbrev").alias("word"), F.col("expansion").alias("replacement"))
    mapped = map_words(words, "_words", pairs)
    return mapped.withColumn("ctext", F.trim(T.join_words(F.col("_words")))).drop("_words")


def _candidates(token: Column, pos: str) -> Column:
    """The word itself and what the suffix rules make of it, in rule order."""
    forms = [token]
    for suffix, ending in V.SUFFIX_RULES[pos]:
        stem = F.substring(token, F.lit(1), F.length(token) - len(suffix))
        forms.append(F.when(token.endswith(suffix), F.concat(stem, F.lit(ending))))
    return F.array(*forms)


def lemma_map(
    vocabulary: DataFrame, lexicon: DataFrame, pos: str, exceptions: DataFrame | None = None
) -> DataFrame:
    """(token, lemma) for the tokens that have another lemma than themselves.

    A token's listed exceptions, else its rule forms, are checked against ``lexicon(lemma, pos)``;
    the shortest form wins, then the earliest rule. Works on distinct words: its joins grow with
    the vocabulary, not with the corpus.
    """
    tokens = vocabulary.select("token").distinct()
    listed = F.lit(None).cast("array<string>")
    if exceptions is not None:
        forms = exceptions.where(F.col("pos") == pos).groupBy(F.col("form").alias("token"))
        forms = forms.agg(F.array_sort(F.collect_set("lemma")).alias("_listed"))
        tokens = tokens.join(forms, "token", "left")
        listed = F.concat(F.array("token"), F.col("_listed"))
    tried = tokens.select(
        "token", F.posexplode(F.coalesce(listed, _candidates(F.col("token"), pos))).alias("_order", "lemma")
    ).where(F.col("lemma").isNotNull())
    known = lexicon.where(F.col("pos") == pos).select("lemma").distinct()
    best = tried.join(known, "lemma", "left_semi").groupBy("token")
    best = best.agg(F.min(F.struct(F.length("lemma").alias("_n"), "_order", "lemma")).alias("_best"))
    return best.select("token", F.col("_best.lemma").alias("lemma")).where(F.col("token") != F.col("lemma"))


def lemmatise(
    df: DataFrame, words: str, lexicon: DataFrame, pos: str = "v", exceptions: DataFrame | None = None
) -> DataFrame:
    """Replace the words of a list column by their lemmas, found once per distinct word."""
    held = _held(df, words)
    counts = materialise(_vocabulary(held, words))
    lemmas = lemma_map(counts.withColumnRenamed("word", "token"), lexicon, pos, exceptions)
    pairs = lemmas.select(F.col("token").alias("word"), F.col("lemma").alias("replacement"))
    return _replace(held, words, counts, _entries(pairs), None).select(*df.columns)


def lemma_counts(
    counts: DataFrame, lexicon: DataFrame, pos: str = "v", exceptions: DataFrame | None = None
) -> DataFrame:
    """Occurrences per lemma from ``counts(token, n)``: joins counted words, never occurrences."""
    lemmas = lemma_map(counts, lexicon, pos, exceptions)
    joined = counts.join(lemmas, "token", "left")
    lemma = F.coalesce("lemma", "token").alias("lemma")
    return joined.groupBy(lemma).agg(F.sum("n").alias("n"))


def tag_table(tagged: DataFrame) -> DataFrame:
    """``tagged(token, tag)`` counted as (token, tag, n)."""
    return tagged.groupBy("token", "tag").agg(F.count("*").alias("n"))


def most_frequent_tags(tag_counts: DataFrame) -> DataFrame:
    """Each token's commonest tag, ties by tag. A token has at most as many rows as there are tags."""
    order = Window.partitionBy("token").orderBy(F.desc("n"), F.asc("tag"))
    ranked = tag_counts.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") == 1).select("token", "tag")


def tag_words(df: DataFrame, words: str, tags: DataFrame, default: str = "NN", name: str = "pos") -> DataFrame:
    """Add a list column with one tag per word; unknown words get ``default``."""
    pairs = tags.select(F.col("token").alias("word"), F.col("tag").alias("replacement"))
    return map_words(df.withColumn(name, F.col(words)), name, pairs, default)


def clean_b_table(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    exceptions: DataFrame | None = None,
    stop: Sequence[str] = V.STOP_WORDS,
) -> DataFrame:
    """Cleaner B with verb lemmas from a lexicon table; adds the list column ``words``."""
    cut = df.withColumn("words", T.clean_b_words(F.col(text), stop))
    lemmas = lemmatise(cut, "words", lexicon, "v", exceptions)
    return lemmas.withColumn("words", T.keep_longer_than(F.col("words"), 2))


def clean_c_table(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    dictionary: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    stop: Sequence[str] = V.STOP_WORDS,
) -> DataFrame:
    """Cleaner C with abbreviations and noun lemmas from tables; adds the text column ``ctext``."""
    cut = df.withColumn("_words", T.split_words(T.strip_noise(F.col(text))))
    if dictionary is not None:
        pairs = dictionary.select(F.col("abbrev").alias("word"), F.col("expansion").alias("replacement"))
        cut = map_words(cut, "_words", pairs)
    cut = cut.withColumn("_words", T.remove_words(F.col("_words"), stop))
    cut = lemmatise(cut, "_words", lexicon, "n", exceptions)
    long = T.keep_longer_than(F.col("_words"), 1)
    return cut.withColumn("ctext", F.trim(T.join_words(long))).drop("_words")
