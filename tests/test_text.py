from pyspark.sql import functions as F

from verbatide.functions import fixed_values as V
from verbatide.functions import text as T
from verbatide.operators import features as X

TWEET = "Stay safe! https://t.co/x #StayHome #covid19 @who"


def test_urls(column):
    assert column(T.strip_urls, [TWEET, "see www.a.b/c?d end", None]) == [
        "Stay safe!  #StayHome #covid19 @who", "see  end", None,
    ]
    assert column(T.blank_urls, ["x httpfoo y"]) == ["x   y"]


def test_markup(column):
    text = "<b>Prices</b> up &amp; <a\nhref> rising"
    assert column(T.strip_markup, [text]) == ["Prices up &amp;  rising"]
    # The second form stays on one line, so the broken tag survives.
    assert column(T.blank_markup, [text]) == [" Prices  up &amp; <a\nhref> rising"]


def test_emoji_ranges(column):
    assert column(T.strip_emoji, ["ok 😀 한 字"]) == ["ok   "]
    assert column(lambda c: T.strip_emoji(c, narrow=True), ["ok 😀 한 字"]) == ["ok  한 字"]


def test_tags_are_unicode_words(column):
    text = "café #café @zoé #19wave"
    assert column(T.hashtags, [text, TWEET, "", None]) == ["café 19wave", "StayHome covid19", "", ""]
    assert column(T.mentions, [text, TWEET]) == ["zoé", "who"]
    assert column(T.blank_hashtags, [text]) == ["café   @zoé  "]
    assert column(T.blank_mentions, [text]) == ["café #café   #19wave"]


def test_marks_digits_symbols(column):
    assert column(T.strip_punctuation, ["a.m, w/o 5€ [x]`{y}~"]) == ["am wo 5€ xy"]
    assert column(T.strip_symbols, ["a-b 5€ ñ_1!"]) == ["ab 5 ñ_1"]
    assert column(T.blank_digits, ["a12b ٣"]) == ["a b  "]


def test_splitting(column):
    assert column(T.split_words, ["a  b", "", " x y z ", None]) == [["a", "b"], [], ["x", "y", "z"], None]
    assert column(T.word_tokens, ["it's a_b, ok"]) == [["it", "s", "a_b", "ok"]]
    assert column(T.raw_tokens, ["it's ok!"]) == [["it", "'", "s", "ok", "!"]]
    assert column(X.lower_tokens, ["A  b"]) == [["a", "b"]]
    assert column(lambda c: X.lower_tokens(c, drop_empty=False), ["A  b"]) == [["a", "", "b"]]


def test_word_filters_keep_duplicates(column):
    kind = "array<string>"
    assert column(lambda c: T.remove_words(c, ["the"]), [["a", "the", "a"]], kind) == [["a", "a"]]
    assert column(lambda c: T.keep_longer_than(c, 2), [["ab", "abc"]], kind) == [["abc"]]
    assert column(X.without_stop_words, [["The", "N'T", "Cat", "cat"]], kind) == [["Cat", "cat"]]


def test_ngrams(column):
    kind = "array<string>"
    rows = [["one", "two"], ["a", "b", "c", "d"], []]
    assert column(lambda c: T.ngrams(c, 3), rows, kind) == [[], ["a b c", "b c d"], []]


ABBREVIATIONS = {
    "idk": "i do not know", "btw": "by the way", "thx": "thank you", "amp": "", "€": " euro ",
    "a.m": "before midday", "CM": "community manager", "u": "you", "you": "WRONG",
}


def test_cleaner_a(column):
    rows = ["idk btw thx", "<b>Prices</b> up &amp; rising", "5 € a.m w/o CM", TWEET, "", None, "u"]
    assert column(lambda c: T.clean_a(c, ABBREVIATIONS), rows) == [
        "i do not know by the way thank you",
        "prices up  rising",  # amp becomes empty and leaves two spaces
        "5  euro  am wo cm",  # keys with marks or capitals can never match
        "stay safe stayhome covid19 who",
        "",
        "",  # a missing text is empty text
        "you",  # an expansion is not expanded again
    ]


def test_cleaner_a_is_stable_without_abbreviations(column):
    once = column(T.clean_a, [TWEET, "A  <i>b</i> 😀"])
    assert column(T.clean_a, once) == once


def test_cleaner_b_order(column):
    rows = ["#covid19 rises", "#19wave late", "The café: http://x.y <p>12 zoé</p> @me", ""]
    assert column(T.clean_b, rows) == [["rises"], ["wave", "late"], ["café", "zoé"], []]


def test_cleaner_b_takes_a_lemma_step(column):
    step = lambda words: T.replace_words(words, {"rising": "rise"})
    assert column(lambda c: T.clean_b(c, lemmatise=step), ["prices rising"]) == [["prices", "rise"]]


def test_cleaner_c_expansion_is_one_word(column):
    # "by the way" is one element, so its stop words stay.
    assert column(lambda c: T.clean_c(c, ABBREVIATIONS), ["btw the x prices"]) == ["by the way prices"]


def test_stop_lists():
    assert len(V.STOP_WORDS) == len(set(V.STOP_WORDS)) == 179
    assert len(V.STOP_MARKS) == 36 and len(set(V.STOP_MARKS)) == 35


def test_against_python_regular_expressions(spark, column):
    """The explicit classes match what Python's Unicode classes match."""
    import re

    rows = ["áb #x́y ²½ Ⅷ _é", "x\x1cy\x85z​w　v", "naïve—ß 中文 #中文_1 @ñ٣"]
    assert column(T.word_tokens, rows) == [re.findall(r"\w+", r) for r in rows]
    assert column(T.split_words, rows) == [r.split() for r in rows]
    assert column(T.strip_symbols, rows) == [re.sub(r"[^\w\s]", "", r) for r in rows]
    assert column(T.blank_digits, rows) == [re.sub(r"\d+", " ", r) for r in rows]
    assert column(T.hashtags, rows) == [" ".join(re.findall(r"(?<=#)\w+", r)) for r in rows]
    assert column(F.lower, rows) == [r.lower() for r in rows]
