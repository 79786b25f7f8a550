"""The corpus operators against brute force, exact round trips and held-out accuracy, on small tables
with nulls, empty texts, ties, repeated rows and clashing column names."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verbatide.llm import bpe_codec, decontaminate, fingerprint, gru, language_id, line_dedup, lm_score
from verbatide.llm import ngram_jaccard, suffix_dedup, token_counts, url_filter
from verbatide.llm.common import Scratch, commonest
from verbatide.llm.components import components

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = "doc_id long, text string"
ODD = [
    "", None, " \n\t", "a", "One two", "Hello <|endoftext|>World's 12 caf\u00e9 \u03a3\u039f\u03a3 \u0130x", "x" * 3000, "=-" * 200,
    "\u00e9 e\u0301 \ufb01 \U0001F600 \u01c5", "a\u00a0b\u2003c\x1cd", "<|startoftext|><|endoftext|>", "don't we'll 3.14",
]


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t) for i, t in enumerate(texts)], TEXTS)


def words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]


def prose(rng, n, vocabulary=40):
    return " ".join(f"w{int(v)}" for v in rng.integers(0, vocabulary, n))


# 1 -----------------------------------------------------------------------------------------------


def brute_components(rows, n, t):
    sets = {}
    for i, (_, text) in enumerate(rows):
        w = words(text)
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and both * t.denominator >= union * t.numerator:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in groups[find(i)] if d is not None]
        out.append((doc, len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def near_copies(seed, count, vocabulary):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        base = prose(rng, int(rng.integers(1, 90)), vocabulary).split()
        for _ in range(int(rng.integers(1, 7))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = f"e{int(rng.integers(5))}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("n,t", [(3, Fraction(9, 10)), (2, Fraction(4, 5)), (1, Fraction(1, 2))])
def test_link_classes_by_brute_force(spark, n, t):
    texts = near_copies(3, 40, 60) + ODD
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "nothing like it"), (7, texts[7]), (7, "another row of this id")]
    df = spark.createDataFrame(rows, TEXTS).withColumn("id", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted(map(tuple, ngram_jaccard.link_classes(df, n, t).collect()), key=repr)
    assert got == brute_components(rows, n, t)


def test_every_linked_pair_meets_twice():
    """The pigeonhole: whatever differs, up to the threshold, two keys agree, or one and an empty segment; where
    one member may differ, one key."""
    rng = np.random.default_rng(5)
    for t in (Fraction(9, 10), Fraction(4, 5), Fraction(2, 3)):
        bands = ngram_jaccard.Bands(t)
        for size in [*range(1, 60), 100, 333, 1000]:
            for _ in range(4):
                pool = rng.integers(0, 1 << 63, 3 * size + 3).astype(np.uint64)
                one = pool[:size]
                most = bands.distance(size)
                drop = int(rng.integers(0, most + 1))
                two = np.concatenate([one[: size - drop], pool[size : size + most - drop]])
                both, union = size - drop, size + most - drop
                if both * t.denominator < union * t.numerator or (not drop and most == drop):
                    continue
                keys, empty = [], []
                for members in (one, two):
                    found = [ngram_jaccard.segments(members, *s) for s in bands.schemes(len(members))]
                    keys.append({k for f, _ in found for k in f.tolist()})
                    empty.append({e for _, f in found for e in f.tolist()})
                met, alike = len(keys[0] & keys[1]), set(one.tolist()) == set(two.tolist())
                few = min(len(one), len(two)) < math.ceil(2 * t / (1 - t))
                assert met > 1 or met and (few or empty[0] & empty[1]) or alike
                # So many keys are left after both sets have given up their most frequent ones, whatever the order of keys.
                spare = min(bands.spare(d) for _, d in bands.schemes(len(one))) if not few else 0
                plain = [k for k in keys[0] & keys[1] if k & 255]
                assert few or alike or len(plain) - spare + len(empty[0] & empty[1]) >= 2
                apart = np.bitwise_count(
                    np.frombuffer(ngram_jaccard.parity_sketch(one), np.uint8) ^ np.frombuffer(ngram_jaccard.parity_sketch(two), np.uint8)
                ).sum()
                assert apart <= len(set(one.tolist()) ^ set(two.tolist()))


def test_crowded_keys_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 3)
    monkeypatch.setattr(ngram_jaccard, "WIDE", 5)
    monkeypatch.setattr(ngram_jaccard, "SAMPLE", 1)
    monkeypatch.setattr(ngram_jaccard, "CROWDED", 10**9)
    rng = np.random.default_rng(8)
    base = prose(rng, 60, 500).split()
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(int(rng.integers(1, 4))):
            copy[int(rng.integers(60))] = f"e{int(rng.integers(40))}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    got = sorted(map(tuple, ngram_jaccard.link_classes(spark.createDataFrame(rows, TEXTS), 3, Fraction(9, 10)).collect()), key=repr)
    assert got == brute_components(rows, 3, Fraction(9, 10))


def test_shares_of_keys_are_all_keys_and_are_shuffled_once(spark):
    rows = [(i // 2, [256 * (i // 6), 257 * (i // 4), 7 << 9, -256 * i]) for i in range(60)]
    sketched = spark.createDataFrame(rows, "id long, keys array<long>")
    whole = ngram_jaccard._buckets(sketched)
    parts = [ngram_jaccard._buckets(sketched, share, 2) for share in range(2)]
    assert all(part.count() for part in parts)
    assert sorted(map(tuple, parts[0].unionByName(parts[1]).collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() == whole.select("key", "id").distinct().count()
    top = whole._jdf.queryExecution().executedPlan().toString().partition("Window")[0]
    assert "Exchange" not in top  # repeated rows go without another shuffle


def test_empty_table_has_no_classes(spark):
    assert ngram_jaccard.link_classes(docs_of(spark, [])).count() == 0


def test_one_document_of_a_class_stays(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "x y z"), (None, "q"), (5, None)]
    df = spark.createDataFrame(rows, TEXTS).withColumn("component_id", F.lit(0))
    kept = ngram_jaccard.keep_one_per_class(df)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 5, None] and kept.columns == df.columns


def test_one_row_of_a_class_stays_among_repeated_rows_and_null_ids(spark):
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, words, 1), (1, words, 1), (1, words, 2), (2, words, 1), (None, words, 1), (None, words, 1)]
    rows += [(None, "q", 1), (None, "q", 1), (1, "other words", 5), (4, "other words", 5), (9, words + " end", 1), (None, None, 1), (None, None, 1)]
    df = spark.createDataFrame(rows, TEXTS + ", copies int")
    kept = ngram_jaccard.keep_one_per_class(df)
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert found == sorted([(1, words), (None, "q"), (1, "other words"), (None, None), (None, None)], key=repr) and kept.columns == df.columns
    assert ngram_jaccard.keep_one_per_class(df.limit(0)).count() == 0


def test_minor_members_meet_all_others(spark):
    """A bundle of two dense groups and single sets between them: links run only through a few members."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(80)]
    texts = []
    for group in range(3):
        own = list(base)
        for k in range(group * 4, group * 4 + 4):
            own[k * 6] = f"g{group}"
        for _ in range(25):
            copy = list(own)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(80))] = f"e{int(rng.integers(500))}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    got = sorted(map(tuple, ngram_jaccard.link_classes(spark.createDataFrame(rows, TEXTS), 2, Fraction(4, 5)).collect()), key=repr)
    assert got == brute_components(rows, 2, Fraction(4, 5))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()))
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


# 2 -----------------------------------------------------------------------------------------------


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeating(seed, count, letters):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 150)))
        if texts and rng.random() < 0.6:
            other = rng.choice(texts)
            at = rng.randrange(len(other) + 1)
            text += other[at : at + rng.randrange(70)]
        texts.append(text)
        if rng.random() < 0.15:
            texts.append(text)
    return texts + ["", "a" * 90, "ab" * 60]


@pytest.mark.parametrize("length,letters,crowd", [(20, "abc", 2048), (13, "abcdefghij\u00e9", 2048), (20, "ab", 3), (31, "abcdefgh", 2)])
def test_repeats_by_brute_force(spark, monkeypatch, length, letters, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = repeating(length, 100, letters)
    df = docs_of(spark, texts).withColumn("raw", F.lit(1)).withColumn("th", F.lit("x"))
    got = sorted(map(tuple, suffix_dedup.remove_repeats(df, length, keep_bytes=False).collect()))
    assert [r[1:] for r in got] == brute_repeats([t.encode() for t in texts], length)


def test_repeats_with_nulls_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (None, "xyz" * 9), (2, ""), (2, "q" * 9), (2, "q" * 9)], TEXTS)
    got = {(r["doc_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(df, 8).collect()}
    assert got == {(1, 0): (0, 0, b""), (None, 27): (27, 1, b""), (2, 0): (0, 0, b""), (2, 9): (9, 1, b"")}
    assert suffix_dedup.remove_repeats(docs_of(spark, []), 8).count() == 0


def test_interval_tree_finds_maximal_repeats():
    """Each interval's repeat, widened to the left as far as all agree, occurs at all its members."""
    rng = random.Random(4)
    text = "".join(rng.choice("ab") for _ in range(120))
    places = sorted(range(10, 120), key=lambda i: text[i:])
    group = suffix_dedup.Group([text[max(0, i - 10) : i][::-1].encode() for i in places], [text[i:].encode() for i in places])
    found = list(group.maximal_repeats(2))
    assert found
    for depth, members, left, common in found:
        strings = {text[places[m] - common : places[m] + depth] for m in members}
        assert len(strings) == 1
        wider = {text[places[m] - common - 1 : places[m] + depth] for m in members}
        assert len(wider) > 1 or common == 10 or any(places[m] - common == 0 for m in members)
        right = {text[places[m] : places[m] + depth + 1] for m in members}
        assert len(right) > 1


def test_long_texts_are_read_in_pieces(monkeypatch):
    raw = np.frombuffer(bytes(random.Random(1).choice(b"abcd") for _ in range(5000)), np.uint8)
    whole = suffix_dedup.Anchors(40)(raw)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 177)
    pieces = suffix_dedup.Anchors(40)(raw)
    assert all((a == b).all() for a, b in zip(whole, pieces))


# 3 -----------------------------------------------------------------------------------------------


def test_language_model_is_ppm_by_brute_force(spark):
    rows = [("en", "the then there, this"), ("fr", "le la les de la"), ("en", "that other"), (None, "zzz"), ("en", None)]
    rows += [("en", "the other then " * 900), ("en", "wxyz")]  # a hot text, and contexts of one in 13,000 bytes
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["en", "fr"]

    def cost(lang, context, byte):
        data = [b"\0\0\0" + t.encode() for name, t in rows if name == lang and t]
        total = 0.0
        for order in range(3, -1, -1):
            tail = context[len(context) - order :]
            after = Counter(d[i] for d in data for i in range(3, len(d)) if d[i - order : i] == tail)
            n, kinds = sum(after.values()), len(after)
            if not n:
                continue
            if after[byte]:
                return total - math.log2(after[byte] / (n + kinds))
            total -= math.log2(kinds / (n + kinds))
        return total + 8.0

    for text in (b"the les", b"xq", b"", b"wxyz rare zzz"):
        padded = b"\0\0\0" + text
        want = [sum(cost(lang, padded[i - 3 : i], padded[i]) for i in range(3, len(padded))) for lang in model.languages]
        assert model.code_lengths([text])[0] == pytest.approx(want, rel=1e-5)


def test_a_table_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_BYTES", 100)
    with pytest.raises(ValueError, match="more than 100"):
        language_id.fit(spark.createDataFrame([("en", "the then there")], "lang string, text string"))


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    rows = spark.createDataFrame([("en", f"text {i} of many") for i in range(30)], "lang string, text string").coalesce(1)
    whole = sorted(map(tuple, language_id.gram_counts(rows, "lang", "text").collect()))
    monkeypatch.setattr(language_id, "_GRAMS", 3)
    assert sorted(map(tuple, language_id.gram_counts(rows, "lang", "text").collect())) == whole


def test_language_of_odd_texts(spark, monkeypatch):
    model = language_id.fit(spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze")], "lang string, text string"))
    rows = [(1, "the dog"), (2, "und der hund"), (3, None), (4, "123 !"), (None, "the"), (1, "the dog")]
    df = spark.createDataFrame(rows, TEXTS).withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(9))
    got = sorted(map(tuple, language_id.identify(df, model).collect()), key=repr)
    assert [(r[0], r[1]) for r in got] == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (None, "en")]
    assert all(0 <= r[2] <= 1 for r in got)
    kept = language_id.keep_identified(df, model)
    assert kept.count() == 4 and kept.columns == df.columns
    nothing = language_id.fit(spark.createDataFrame([], "lang string, text string"))
    assert {r["lang_pred"] for r in language_id.identify(df, nothing).collect()} == {"und"}
    texts = [b"the dog and der hund", b"", b"katze" * 50]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(language_id, "_CHUNK", 7)
    assert model.code_lengths(texts) == pytest.approx(whole)


# 4 -----------------------------------------------------------------------------------------------

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
         ("block", "a.b.com"), ("allow", "a.b.com/x/y"), ("block", "a.b.com/x/y"), ("block", "com/fr/secret/")]
URLS = [
    None, "", "no scheme", "http://example.org", "http://EXAMPLE.org/en/129?x=/es/", "https://x.example.org/es/#a",
    "https://badexample.org/es/", "ftp://n.com/de", "ftp://n.com/de/", "http://n.com/fr/secret", "http://n.com/fr/secret/1",
    "http://z.a.b.com/x/yy/z", "http://a.b.com?x", "http://com/de/x", "http://..com/fr//", "x://y://n.org/", "http://org/" + "p/" * 5000,
]


def test_url_verdicts_by_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash")).withColumn("host", F.lit(1))
    got = url_filter.filter_urls(df, RULES).orderBy("page_id").collect()
    assert len(got) == len(rows)
    for row, (_, url) in zip(got, rows):
        host, path = url_filter.split_url(url)
        fits = []
        for verdict, rule in RULES:
            name, slash, rest = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
                fits.append((len(rule), len(name), verdict == "block", rule, verdict))
        want = (max(fits)[3:] if fits else (None, "allow"))
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, *want)
    assert url_filter.filter_urls(df.limit(0), RULES).count() == 0


def test_rules_are_checked(monkeypatch):
    with pytest.raises(ValueError):
        url_filter.UrlTrie([("maybe", "org/")])
    monkeypatch.setattr(url_filter, "MAX_RULES", 1)
    with pytest.raises(ValueError):
        url_filter.UrlTrie(RULES)


# 5 and 10 ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.mark.parametrize("block", [1 << 18, 3])
def test_counts_are_the_library_s(spark, library, monkeypatch, block):
    monkeypatch.setattr(token_counts, "BLOCK", block)
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 5)
    texts = ODD + near_copies(1, 5, 30)
    df = docs_of(spark, texts).unionByName(spark.createDataFrame([(None, "null id"), (0, "again")], TEXTS)).withColumn("n_tokens", F.lit(-1))
    got = token_counts.count_tokens(df, VOCABULARY, 5).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in [*enumerate(texts), (None, "null id"), (0, "again")])
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 5) for r in got)
    assert token_counts.count_tokens(docs_of(spark, []), VOCABULARY, 5).count() == 0


def test_merging_runs_of_one_letter():
    bpe, library = token_counts.WordBpe(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    texts = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)] + ["!" * 77]
    ids, counts = bpe.merge(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t).ids for t in texts]


def test_codec_is_the_library_s_and_round_trips(spark, library):
    texts = ODD + near_copies(2, 10, 30)
    df = docs_of(spark, texts).withColumn("ids", F.lit("clash"))
    got = {r["doc_id"]: r for r in bpe_codec.encode_texts(df, VOCABULARY, most=20).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert got[i]["text"] == text
    again = bpe_codec.decode_ids(bpe_codec.encode_texts(df, VOCABULARY).drop("decoded"), VOCABULARY).collect()
    assert all(r["decoded"] == got[r["doc_id"]]["decoded"] for r in again)
    assert bpe_codec.encode_texts(docs_of(spark, []), VOCABULARY, digests=True).count() == 0


def test_codec_turns_few_texts_into_strings_at_a_time(library, monkeypatch):
    monkeypatch.setattr(bpe_codec, "_SLICE", 20)
    texts = ["a b", None, "", "c" * 50, "long text of more than twenty bytes", "\u00e9t\u00e9 d", None, "e"]
    slices = [s.to_pylist() for s in bpe_codec._slices(pa.array([*texts, "cut off"], pa.string()).slice(0, len(texts)))]
    assert [t for s in slices for t in s] == texts and len(slices) > 2
    assert all(sum(len((t or "").encode()) for t in s[:-1]) < 20 for s in slices)
    assert [s.to_pylist() for s in bpe_codec._slices(pa.array([], pa.string()))] == [[]]
    # Of a known word only the ids are kept, and a full cache starts anew.
    monkeypatch.setattr(bpe_codec, "CACHED_WORDS", 3)
    codec = bpe_codec.BpeCodec(VOCABULARY)
    for part in [*slices, *slices]:
        for text, (ids, decoded) in zip(part, codec.encode(part)):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)
    assert all(isinstance(ids, bytes) for ids in codec.known.values())


def test_transducer_maps_listed_words_only(tmp_path):
    listed = sorted({f"{a}{b}ing" for a in "abcdef" for b in ("", "x", "yz")} | {"a", "ab", "abc", "\u00e9t\u00e9"}, key=str.encode)
    made = bpe_codec.compile_lexicon(listed, VOCABULARY)
    (tmp_path / "lexicon").write_bytes(made.to_bytes())
    mapped = bpe_codec.Transducer.mapped(str(tmp_path / "lexicon"))
    tried = [w.encode() for w in [*listed, "", "abcd", "zing", "axin", "b"]]
    assert mapped.places(tried).tolist() == [*range(len(listed)), -1, -1, -1, -1, -1]
    assert len(mapped.final) < sum(map(len, listed)) / 2  # suffixes are shared
    assert bpe_codec.Transducer.build([], []).places([b"a", b""]).tolist() == [-1, -1]


def test_commonest_cuts_between_counts(spark):
    rows = spark.createDataFrame([(i, 1000 // (i + 1)) for i in range(100)], "w int, n long")
    assert 0 < commonest(rows, 10).count() <= 10 and commonest(rows, 1000).count() == 100
    assert min(r["n"] for r in commonest(rows, 10).collect()) > 90


# 6 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("samples", [fingerprint.SAMPLES, 64])
def test_fingerprints_estimate_generalised_jaccard(spark, samples):
    """Also at the query's number of samples, where the standard error is sqrt(j (1 - j) / 32), 0.088 at most."""
    rng = np.random.default_rng(9)
    texts = []
    for _ in range(60):
        a = prose(rng, 80, 25).split()
        texts += [" ".join(a), " ".join(a[:60] + prose(rng, 30, 25).split())]
    made = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(docs_of(spark, texts), samples=samples).collect()}
    errors = []
    for i in range(0, len(texts), 2):
        one, two = Counter(texts[i].split()), Counter(texts[i + 1].split())
        truth = sum((one & two).values()) / sum((one | two).values())
        parts = [[made[k][j : j + 8] for j in range(0, 8 * samples, 8)] for k in (i, i + 1)]
        errors.append(sum(a == b for a, b in zip(*parts)) / samples - truth)
    # 60 pairs: the mean's error is an eighth of one estimate's, which is at most sqrt(1 / 4 / samples).
    assert abs(np.mean(errors)) < 4 * math.sqrt(0.25 / samples / 60) and np.std(errors) < 1.3 * math.sqrt(0.25 / samples)


def test_edited_texts_by_brute_force(spark):
    rows = [(4, "b c d e f g"), (2, "caf\u00e9 \U0001F600 x"), (9, None), (1, "a"), (7, ""), (4, "b c d e f g"), (None, "null id"), (4, "other"), (8, "z " * 500)]
    df = spark.createDataFrame(rows, TEXTS).withColumn("n_chars", F.lit("clash")).withColumn("text0", F.lit(1))
    got = fingerprint.fingerprints_with_edits(df, samples=8).collect()
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = Counter()
    for at, (doc, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want[doc, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    same = [r for r in got if r["doc_id"] == 4 and r["n_chars"] == 11]
    assert len({r["fingerprint"] for r in same}) == 1 and sum(r["near_next"] == 1.0 for r in same) >= 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprint.fingerprints_with_edits(docs_of(spark, [])).count() == 0
    alone = fingerprint.fingerprints_with_edits(docs_of(spark, ["one two three"])).first()
    assert alone["near_next"] == 1.0


# 7 -----------------------------------------------------------------------------------------------


def test_gru_gradients_and_probabilities(monkeypatch):
    monkeypatch.setattr(gru, "LANES", 1)
    net = gru.Gru(40, 3)
    state = np.random.default_rng(1).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    ids = np.arange(43)
    assert np.exp(net.log_prob(np.repeat(state, 43, 0), ids)).sum() == pytest.approx(1, abs=1e-5)
    stream = np.random.default_rng(2).integers(0, 43, 16)
    starts = np.zeros(16, bool)
    starts[[0, 9]] = True
    kept = {}

    class Keep:
        def update(self, p, g):
            kept.update({k: v.copy() for k, v in g.items()})

    net.train(stream, starts, Keep())

    def loss():
        return -net.score([stream[:9], stream[9:]]).sum() / 16

    for name in net.SHAPES:
        place = np.unravel_index(np.abs(kept[name]).argmax(), kept[name].shape)
        old = net.p[name][place]
        net.p[name][place] = old + 0.01
        above = loss()
        net.p[name][place] = old - 0.01
        slope = (above - loss()) / 0.02
        net.p[name][place] = old
        assert slope == pytest.approx(kept[name][place], rel=0.05, abs=1e-5)


def test_state_runs_through_windows():
    """A text scored alone, in company, and step by step gives one likelihood."""
    net = gru.Gru(40, 3)
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 43, n) for n in (1, 5, 16, 17, 100, 33)]
    together = net.score(texts)
    for text, total in zip(texts, together):
        assert net.score([text])[0] == pytest.approx(total, rel=1e-5)
        state, last, by_step = np.zeros((1, gru.HIDDEN), np.float32), net.begin, 0.0
        for word in text:
            state = net.step(np.array([last]), state)[0]
            by_step += net.log_prob(state, np.array([word]))[0]
            last = word
        assert by_step == pytest.approx(total, rel=1e-4)


def test_base_scores_by_brute_force_and_model_beats_them(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LISTED", 30)
    rng = random.Random(6)
    texts = []
    for _ in range(300):
        text = []
        for _ in range(rng.randrange(0, 12)):
            text += rng.choice([["the", "cat"], ["a", "dog"], ["sat", "down", "there"], [f"rare{rng.randrange(200)}"]])
        texts.append(" ".join(text))
    rows = [*enumerate(texts), (900, None), (901, "THE Cat"), (901, "THE Cat"), (None, "the zebra")]
    df = spark.createDataFrame(rows, TEXTS).withColumn("score", F.lit("clash"))
    train = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    got = lm_score.score_texts(df, train).collect()
    counts, ends = Counter(), 0
    for doc, text in rows:
        if doc is not None and doc % 3 != 0:
            counts.update(words(text))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    want = Counter()
    for doc, text in rows:
        w = words(text)
        base = sum(math.log10((counts[x] + 1) / (total + 1 * (kinds + 1))) for x in w) + math.log10((ends + 1) / (total + kinds + 1))
        want[doc, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 3 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm_score.score_texts(docs_of(spark, []), F.lit(True)).count() == 0
    untaught = lm_score.score_texts(docs_of(spark, ["a b", None]), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in untaught)


def test_gru_with_blocks_of_rare_classes(monkeypatch):
    """Probabilities add up, gradients agree with slopes, and one step changes only rows that it touched."""
    monkeypatch.setattr(gru, "LANES", 1)
    monkeypatch.setattr(gru, "HEADS", 2)
    monkeypatch.setattr(gru, "SPAN", 3)
    net = gru.Gru(300, 3)
    assert (net.heads, net.blocks) == (2, 3)
    counts = np.arange(303, 0, -1)
    net.start_at(counts)
    state = np.random.default_rng(1).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    at_rest = np.exp(net.log_prob(np.zeros((303, gru.HIDDEN), np.float32), np.arange(303)))
    assert at_rest == pytest.approx((counts + 0.5) / (counts + 0.5).sum(), rel=1e-3)
    assert np.exp(net.log_prob(np.repeat(state, 303, 0), np.arange(303))).sum() == pytest.approx(1, abs=1e-5)
    stream = np.append(np.random.default_rng(2).integers(0, 303, 13), [290, 290, 100])
    starts = np.zeros(16, bool)
    starts[[0, 9]] = True
    kept = {}

    class Keep:
        def update(self, p, g):
            kept.update({k: v.copy() for k, v in g.items()})

    net.train(stream, starts, Keep())

    def loss():
        return -net.score([stream[:9], stream[9:]]).sum() / 16

    for name in net.SHAPES:
        for place in np.argsort(-np.abs(kept[name]).ravel())[:3]:
            place = np.unravel_index(place, kept[name].shape)
            old = net.p[name][place]
            net.p[name][place] = old + 0.02
            above = loss()
            net.p[name][place] = old - 0.02
            slope = (above - loss()) / 0.04
            net.p[name][place] = old
            assert slope == pytest.approx(kept[name][place], rel=0.05, abs=1e-4)
    before = {k: v.copy() for k, v in net.p.items()}
    net.train(stream, starts, gru.Adam())
    met = set((stream[stream < 300] // gru.WIDTH).tolist())
    changed = (net.p["words"] != before["words"]).any(axis=(1, 2))
    assert set(np.flatnonzero(changed).tolist()) == met
    again = gru.Gru(300, 3)
    again.load(net.flat())
    assert all((again.p[k] == v).all() for k, v in net.p.items())


def test_entries_cover_the_stated_share_of_training_words(spark):
    """Words that outnumber any fixed list of entries are entries as far as the coverage goes."""
    texts = [" ".join(f"w{i % 3000}" for i in range(low, low + 100)) for low in range(0, 6000, 100)]
    rows = docs_of(spark, texts).select("doc_id", "text", F.lit(True).alias("train"))
    known = lm_score.build_vocabulary(lm_score.word_counts(rows, "text", "train"), len(texts))
    assert known.entries == 1 + math.ceil(lm_score.COVERAGE * 3000) == 2401
    assert known.entry_counts[1 : known.entries].sum() >= lm_score.COVERAGE * 6000
    assert known.entry_counts.sum() == 6000 + len(texts)


# 8 -----------------------------------------------------------------------------------------------


def brute_leaks(docs, items, window=13):
    best = {}
    for doc, text in docs:
        d = words(text)
        for item, passage in items:
            w = words(passage)
            width = min(window, len(w))
            if not w:
                continue
            for start in range(-len(w) + 1, len(d)):
                low, high = max(0, -start), min(len(w), len(d) - start)
                for j in range(low, high - width + 1):
                    equal = sum(w[k] == d[start + k] for k in range(j, j + width))
                    if equal == width if len(w) < 8 else equal * 5 >= width * 4:
                        found = (equal, width, -(start + j))
                        best[doc, item] = max(best.get((doc, item), found), found)
    return sorted((d, i, e, w, -s) for (d, i), (e, w, s) in best.items())


def test_leaks_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(12)
    items = [(i, prose(rng, int(rng.integers(8, 40)), 300)) for i in range(12)] + [(50, "too short"), (51, None), (3, prose(rng, 20, 300)), (54, " \n")]
    items += [(60, "w7"), (61, "w8 w9"), (62, prose(rng, 5, 300)), (63, prose(rng, 7, 300))]
    docs = []
    for i in range(60):
        text = prose(rng, int(rng.integers(0, 60)), 300).split()
        if i % 2:
            passage = (items[int(rng.integers(12))][1] or "").split()
            cut = int(rng.integers(0, 3))
            passage = passage[cut:]
            for _ in range(int(rng.integers(0, 4))):
                passage[int(rng.integers(len(passage)))] = "changed"
            at = int(rng.integers(0, len(text) + 1))
            text = text[:at] + passage + text[at:]
        docs.append((i, " ".join(text).upper() if i % 5 == 0 else "\t".join(text)))
    docs += [(70, None), (71, ""), (72, items[0][1])]
    docs += [(80 + i, f"x y {items[-1 - i % 4][1]} z") for i in range(8)] + [(90, items[-1][1].rsplit(" ", 1)[0] + " changed"), (91, "w8 W9")]
    df = spark.createDataFrame(docs, TEXTS).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    merged = {}
    for doc, item, *rest in brute_leaks(docs, list(dict(enumerate(items)).values())):
        merged[doc, item] = (doc, item, *rest)
    got = sorted(map(tuple, decontaminate.find_leaks(df, bench).collect()))
    assert got == sorted(merged.values())
    kept = decontaminate.drop_leaks(df, bench)
    leaked = {r[0] for r in got}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaked)
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(df.limit(0), bench).count() == 0
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    joined = decontaminate.find_leaks(df, bench)
    assert sorted(map(tuple, joined.collect())) == got


def test_masks_hold_for_any_two_changes():
    from itertools import combinations

    for bad in combinations(range(13), 2):
        assert any(all(i + o not in bad for o in m) for m in decontaminate.MASKS for i in range(13 - m[-1]))
    for size in range(decontaminate.SPACED_WORDS, 13):
        for bad in combinations(range(size), size // 5):
            assert any(all(i + o not in bad for o in m) for m in decontaminate.SHORT_MASKS for i in range(size - m[-1]))


# 9 -----------------------------------------------------------------------------------------------


def brute_lines(rows, min_docs=3, min_chars=20):
    cut = [(doc, (text or "").split("\n")) for doc, text in rows]

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    holders = {}
    for at, (doc, lines) in enumerate(cut):
        for k in {key(x) for x in lines if len(key(x)) >= min_chars}:
            holders.setdefault(k, []).append(doc)
    out = []
    for doc, lines in cut:
        kept = []
        for line in lines:
            who = holders.get(key(line), [])
            known = [d for d in who if d is not None]
            last = max(known) if known else None
            if len(who) < min_docs or doc == last:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_by_brute_force(spark):
    rng = random.Random(2)
    pool = [f"{'Shared line number' if i % 2 else '  shared LINE of some \u00c9length'} {i}" for i in range(12)]
    rows = []
    for i in range(50):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own line of document {i} {rng.random()}" for _ in range(rng.randrange(6))]
        if lines and rng.random() < 0.3:
            lines.append(lines[0].upper() + " \r")
        rows.append((i if i % 9 else None, "\n".join(lines)))
    rows += [(99, None), (98, "\n\n"), (5, rows[5][1]), (97, pool[0] + "\n" + pool[0])]
    df = spark.createDataFrame(rows, TEXTS).withColumn("kept", F.lit("clash")).withColumn("key", F.lit(1))
    df = df.withColumns({name: F.lit(1) for name in ("_id", "_text", "_same", "_drop", "_lines", "last")})
    got = line_dedup.dedup_lines(df, batches=5).select("doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_lines(rows)
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_runs_merge_by_level(spark):
    runs = line_dedup.LineRuns(spark, buckets=4)
    for n in range(5):
        batch = spark.createDataFrame([(f"k{n}", 1, n), ("all", 1, n)], "key string, n_docs long, last long")
        runs.add(batch)
    assert [bool(run) for run in runs.lines] == [True, False, True]  # five batches: one and four
    assert [bool(run) for run in runs.updates] == [False, False, True]  # the four batches that met a known key
    held = [r["key"] for run in filter(None, runs.lines) for r in spark.table(run[0]).collect()]
    assert sorted(held) == ["all", "k0", "k1", "k2", "k3", "k4"]
    new = spark.createDataFrame([("k3",), ("new",), ("all",)], "key string")
    assert [r["key"] for r in runs.fresh(new).collect()] == ["new"]
    plan = runs.fresh(new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1  # only the batch moves
    assert {tuple(r) for r in runs.compact().where("key = 'all'").collect()} == {("all", 5, 4)}
    runs.drop()


def test_crc_matches_zlib(spark):
    from verbatide.llm.common import crc_mod

    rows = spark.createDataFrame([(0,), (17,), (123456,), (None,)], "doc_id long").withColumn("m", crc_mod(F.col("doc_id"), 5))
    for row in rows.collect():
        text = "" if row["doc_id"] is None else str(row["doc_id"])
        assert row["m"] == zlib.crc32(text.encode()) % 5


def test_language_fit_holds_little_beside_its_table(spark):
    """The driver holds the counts as arrays: a row and a dictionary entry for each came to several times the table."""
    rng = np.random.default_rng(7)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789.,;:", np.uint8)
    rows = [(lang, rng.choice(letters, 100_000).tobytes().decode()) for lang in ("a", "a\0", "b", "c")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    language_id.fit(docs.limit(1))  # imports and session objects are not counted
    tracemalloc.start()
    try:
        model = language_id.fit(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["a", "a\0", "b", "c"]
    bits = model.code_lengths([text.encode() for _, text in rows])
    assert bits.argmin(axis=1).tolist() == [0, 1, 2, 3]
    assert peak < 3.5 * model.table.nbytes
