"""Text columns: clean, extract, split, filter. Native expressions only.

Word membership tests use ``isin``: beyond ten values Catalyst turns it into one hash set per
task, so a stop list or a dictionary costs one probe per word however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V


def as_text(c: Column) -> Column:
    """Any value as text; a missing value is empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, V.URL, "")


def blank_urls(c: Column) -> Column:
    return F.regexp_replace(c, V.HTTP_RUN, " ")


def strip_markup(c: Column) -> Column:
    return F.regexp_replace(c, V.TAG, "")


def blank_markup(c: Column) -> Column:
    return F.regexp_replace(c, V.TAG_ON_ONE_LINE, " ")


def strip_emoji(c: Column, narrow: bool = False) -> Column:
    """Drop emoji. The default's last range also covers CJK, kana and Hangul; ``narrow`` spares them."""
    return F.regexp_replace(c, V.EMOJI_NARROW if narrow else V.EMOJI, "")


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, V.ASCII_PUNCTUATION, "")


def strip_symbols(c: Column) -> Column:
    return F.regexp_replace(c, V.NOT_WORD_OR_SPACE, "")


def blank_digits(c: Column) -> Column:
    return F.regexp_replace(c, V.DIGITS, " ")


def blank_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, V.HASHTAG, " ")


def blank_mentions(c: Column) -> Column:
    return F.regexp_replace(c, V.MENTION, " ")


def hashtag_list(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(V.HASHTAG_BODY), F.lit(1))


def mention_list(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(V.MENTION_BODY), F.lit(1))


def hashtags(c: Column) -> Column:
    """All hashtags of a text, joined by spaces; empty text when there is none."""
    return F.concat_ws(" ", hashtag_list(c))


def mentions(c: Column) -> Column:
    return F.concat_ws(" ", mention_list(c))


def split_words(c: Column) -> Column:
    """Whitespace split without empty words."""
    return F.array_remove(F.split(c, V.SPACES), "")


def word_tokens(c: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_extract_all(c, F.lit(V.WORDS), F.lit(0))


def count_tokens(c: Column) -> Column:
    """Lower-cased runs of two or more word characters: the words that count vectors are made of."""
    return F.regexp_extract_all(F.lower(c), F.lit(V.LONG_WORDS), F.lit(0))


def raw_tokens(c: Column) -> Column:
    """Words and single marks, in order: the tokeniser for uncleaned text."""
    return F.regexp_extract_all(c, F.lit(V.WORDS_OR_MARKS), F.lit(0))


def join_words(words: Column) -> Column:
    return F.concat_ws(" ", words)


def remove_words(words: Column, stop: Sequence[str]) -> Column:
    stop = list(dict.fromkeys(stop))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def keep_longer_than(words: Column, n: int) -> Column:
    return F.filter(words, lambda w: F.length(w) > n)


def replace_words(words: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Replace whole words once; replacements are not looked up again. For small mappings.

    Words outside the mapping stay, or become ``default``, and so do words whose replacement is missing.
    """
    mapping = {word: new for word, new in mapping.items() if word is not None and new is not None}
    if not mapping:
        return words if default is None else F.transform(words, lambda _: F.lit(default))
    keys = list(mapping)
    table = F.map_from_arrays(
        F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(mapping[k]) for k in keys])
    )

    def replaced(w: Column) -> Column:
        other = w if default is None else F.lit(default)
        return F.when(w.isin(keys), F.element_at(table, w)).otherwise(other)

    return F.transform(words, replaced)


def word_count(words: Column) -> Column:
    return F.size(words).cast("long")


def ngrams(words: Column, n: int) -> Column:
    """Space-joined n-grams of a word list; shorter lists give none."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    grams = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i + 1, n)))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


# Cleaners. The word step is passed in, so the same text can take a small mapping here or a
# dictionary join in ``operators.lexicon``.

WordStep = Callable[[Column], Column]


def strip_noise(c: Column) -> Column:
    """Lower case, then no URLs, markup, emoji or ASCII punctuation."""
    return strip_punctuation(strip_emoji(strip_markup(strip_urls(F.lower(c)))))


def clean_a(c: Column, abbreviations: Mapping[str, str] | None = None) -> Column:
    """Noise stripped, abbreviations expanded, words joined by one space, ends trimmed."""
    words = replace_words(split_words(strip_noise(c)), abbreviations or {})
    return F.trim(join_words(words))


def clean_b_words(c: Column, stop: Sequence[str] = V.STOP_WORDS) -> Column:
    """Cleaner B up to the lemma step. Digits go before hashtags, so ``#19wave`` keeps ``wave``."""
    blanked = blank_mentions(blank_hashtags(blank_digits(blank_markup(blank_urls(c)))))
    return remove_words(word_tokens(F.lower(strip_symbols(blanked))), stop)


def clean_b(
    c: Column, stop: Sequence[str] = V.STOP_WORDS, lemmatise: WordStep = lambda words: words
) -> Column:
    """Words without URLs, markup, digits, tags, marks, stop words and words of one or two letters."""
    return keep_longer_than(lemmatise(clean_b_words(c, stop)), 2)


def clean_c(
    c: Column,
    abbreviations: Mapping[str, str] | None = None,
    stop: Sequence[str] = V.STOP_WORDS,
    lemmatise: WordStep = lambda words: words,
) -> Column:
    """As cleaner A, then stop words, lemmas and words of two letters or more; an expansion of
    several words counts as one word."""
    words = replace_words(split_words(strip_noise(c)), abbreviations or {})
    return F.trim(join_words(keep_longer_than(lemmatise(remove_words(words, stop)), 1)))
