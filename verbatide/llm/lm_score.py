"""Language-model scores of whole texts: a recurrent model over words, fitted on all training texts.

* Words of all texts are counted in Spark. The commonest ``LISTED`` words, with their training
  counts, are broadcast; the counts of all others stay a table and are joined to the texts' rare words.
  No word left to that join is common, so it has no hot key.
* The commonest words that make up ``COVERAGE`` of the training words (``MOST_ENTRIES`` at most) are entries of the model. All other words fall into ``OTHERS`` classes by their
  last two bytes; within a class a word has probability (c + 1) / (N + V + 1), c being its training count and N and V
  the class's tokens and distinct words, so that unseen words have a share too.
* Fitting is data-parallel: in each round every task runs truncated backpropagation over its own training
  texts from the same parameters, and the parameters are averaged by tokens, as a grouped sum in
  Spark. ``ROUNDS`` rounds share the training texts; each text is used once, whole.
* Scoring carries the state through the whole text, window after window.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch, commonest
from verbatide.llm.gru import Adam, Gru

COVERAGE = 0.8  # share of the training words that are entries
MOST_ENTRIES = 1 << 18  # entries at most: bounds what every task holds; further words are in the classes of others
OTHERS = 32
LISTED = 1 << 17
ROUNDS = 2
_COUNTED = 500_000  # distinct words that a task holds before it passes their counts on
_STREAM = 1 << 20  # training tokens taken at a time
_PART = 1 << 13  # parameters sent in one row
_SHARES = 8  # shares of the tasks that are averaged first
_PIECE = 8 << 20  # bytes of text cut into words at a time; a longer text is a piece by itself


def other_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % OTHERS


@dataclass
class Words:
    """Some texts cut into words: ``words`` are distinct, ``at`` numbers the word at each place, text after text."""

    rows: slice
    words: list[bytes]
    at: np.ndarray
    sizes: np.ndarray


def cut_words(texts: pa.Array) -> Iterator[Words]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, in pieces of texts. Arrow's splitter knows exactly these spaces."""
    held: list[bytes] = []
    first, size = 0, 0
    for number, value in enumerate(texts):
        raw = value.as_py()
        held.append(raw.encode("utf-8", "surrogatepass").lower().strip() if raw else b"")
        size += len(held[-1])
        if size >= _PIECE or number == len(texts) - 1:
            cut = pc.ascii_split_whitespace(pa.array(held, pa.binary()).cast(pa.string()))
            coded = cut.flatten().dictionary_encode()
            at = coded.indices.to_numpy().astype(np.int64)
            sizes = pc.list_value_length(cut).to_numpy().astype(np.int64)
            empty = np.array([not t for t in held], bool)
            if empty.any():  # one empty word each
                at, sizes = at[~np.repeat(empty, sizes)], np.where(empty, 0, sizes)
            yield Words(slice(first, number + 1), coded.dictionary.cast(pa.binary()).to_pylist(), at, sizes)
            held, first, size = [], number + 1, 0


def word_counts(docs: DataFrame, text: str, training: str) -> DataFrame:
    """(word, kind, n, n_train) over all texts; ``kind`` is the class the word has when it is no entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(held, pa.binary()),
                    pa.array([other_class(w) for w in held], pa.int32()),
                    pa.array([n for n, _ in held.values()], pa.int64()),
                    pa.array([n for _, n in held.values()], pa.int64()),
                ],
                ["word", "kind", "n", "n_train"],
            )

        for batch in batches:
            train = np.array(batch.column(1).to_pylist(), bool)
            for piece in cut_words(batch.column(0)):
                taught = np.repeat(train[piece.rows], piece.sizes)
                n = np.bincount(piece.at, minlength=len(piece.words)).tolist()
                n_train = np.bincount(piece.at[taught], minlength=len(piece.words)).tolist()
                for word, x, y in zip(piece.words, n, n_train):
                    if x:
                        pair = held.get(word)
                        if pair is None:
                            held[word] = [x, y]
                        else:
                            pair[0] += x
                            pair[1] += y
                if len(held) > _COUNTED:
                    yield rows()
                    held = {}
        yield rows()

    counts = docs.select(text, training).mapInArrow(run, "word binary, kind int, n long, n_train long")
    return counts.groupBy("word", "kind").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


@dataclass
class Vocabulary:
    """What tasks need of the counts: listed words with training counts, entries, class totals."""

    listed: dict[bytes, int]  # word to place in the arrays below
    counts: np.ndarray  # training tokens of each listed word
    entries: int  # the end of a text and the words that are entries
    entry: np.ndarray  # its entry id; ids from ``entries`` on are classes of other words
    entry_counts: np.ndarray  # training tokens of each entry id
    class_log: np.ndarray  # log10(N + V + 1) of each class of other words
    tokens: int  # N, ends of texts included
    distinct: int  # V, the end included
    ends: int

    def code(self, piece: Words) -> tuple[np.ndarray, np.ndarray]:
        """(place in the arrays or -1, entry id) of the distinct words of a piece."""
        place = np.fromiter(map(self.listed.get, piece.words, repeat(-1)), np.int64, len(piece.words))
        entry = self.entry[place]
        for i in np.flatnonzero(place < 0):
            entry[i] = self.entries + other_class(piece.words[i])
        return place, entry

    def ids(self, piece: Words, entry: np.ndarray) -> np.ndarray:
        """Entry ids of a piece, each text followed by its end."""
        ends = np.cumsum(piece.sizes + 1) - 1
        ids = np.zeros(len(piece.at) + len(ends), np.int64)
        inside = np.ones(len(ids), bool)
        inside[ends] = False
        ids[inside] = entry[piece.at]
        return ids


def covering(counts: DataFrame) -> DataFrame | None:
    """The commonest training words that make up ``COVERAGE`` of all, and words about as common as the last of them."""
    step = F.floor(F.log2(F.col("n_train").cast("double")) * 16)
    taught = counts.where("n_train > 0")
    sizes = taught.groupBy(step.alias("step")).agg(F.sum("n_train").alias("n")).collect()
    left = COVERAGE * sum(r["n"] for r in sizes)
    for row in sorted(sizes, key=lambda r: -r["step"]):
        left -= row["n"]
        if left <= 0:
            return taught.where(step >= row["step"])
    return None


def build_vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    wanted = covering(counts)
    wanted = commonest(wanted, MOST_ENTRIES, "n_train") if wanted is not None else None
    listed = commonest(counts, LISTED).select("word", "kind", "n_train")
    if wanted is not None:
        listed = listed.union(wanted.select("word", "kind", "n_train")).distinct()
    listed = sorted(listed.collect(), key=lambda r: bytes(r["word"]))
    rank = sorted(range(len(listed)), key=lambda i: (-listed[i]["n_train"], listed[i]["word"]))
    trained = counts.agg(F.sum("n_train")).first()[0] or 0
    before = np.cumsum([0] + [listed[i]["n_train"] for i in rank])
    chosen = rank[: min(MOST_ENTRIES - 1, int(np.searchsorted(before, COVERAGE * trained)))] if trained else []
    entries = len(chosen) + 1
    entry = np.array([entries + r["kind"] for r in listed] or [entries], np.int64)
    entry[chosen] = np.arange(1, entries)
    seen = F.col("n_train") > 0
    per_class = counts.groupBy("kind").agg(F.sum("n_train").alias("n"), F.sum(seen.cast("long")).alias("v"))
    totals, distinct = np.zeros(OTHERS, np.int64), np.zeros(OTHERS, np.int64)
    for row in per_class.collect():
        totals[row["kind"]], distinct[row["kind"]] = row["n"], row["v"]
    tokens, words = int(totals.sum()), int(distinct.sum())
    entry_counts = np.zeros(entries + OTHERS, np.int64)
    entry_counts[0] = ends
    for i in chosen:
        row = listed[i]
        entry_counts[entry[i]] = row["n_train"]
        totals[row["kind"]] -= row["n_train"]
        distinct[row["kind"]] -= 1
    entry_counts[entries:] = totals
    return Vocabulary(
        {bytes(r["word"]): i for i, r in enumerate(listed)},
        np.array([r["n_train"] for r in listed] or [0], np.int64),
        entries,
        entry,
        entry_counts,
        np.log10(totals + distinct + 1.0),
        tokens + ends,
        words + (1 if ends else 0),
        ends,
    )


def _mean(rows: pa.Table) -> pa.Table:
    """Mean of one part of the parameters, by tokens."""
    total, n = 0.0, 0
    for values, tokens in zip(rows.column("values"), rows.column("n").to_pylist()):
        total = total + np.frombuffer(values.as_py(), np.float32).astype(np.float64) * tokens
        n += tokens
    mean = (total / n).astype(np.float32).tobytes()
    return pa.table({"part": rows.column("part")[:1], "values": pa.array([mean], pa.binary()), "n": pa.array([n], pa.int64())})


def fit_model(docs: DataFrame, text: str, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after ``rounds`` of local training and averaging over the texts of ``docs``."""
    spark = docs.sparkSession
    model = Gru(vocabulary.entries, OTHERS)
    model.start_at(vocabulary.entry_counts)
    share = F.pmod(F.xxhash64(F.col(text)), F.lit(rounds))
    words = spark.sparkContext.broadcast(vocabulary)
    for number in range(rounds):
        begin = spark.sparkContext.broadcast(model.flat())

        def run(batches: Iterator[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            net, optimiser, total = Gru(words.value.entries, OTHERS), Adam(), 0
            net.load(begin.value)
            pending: list[tuple[np.ndarray, np.ndarray]] = []

            def learn() -> int:
                stream = np.concatenate([ids for ids, _ in pending])
                sizes = np.concatenate([sizes for _, sizes in pending])
                starts = np.zeros(len(stream), bool)
                starts[np.cumsum(sizes) - sizes] = True
                net.train(stream, starts, optimiser)
                pending.clear()
                return len(stream)

            held = 0
            for batch in batches:
                for piece in cut_words(batch.column(0)):
                    known = words.value
                    pending.append((known.ids(piece, known.code(piece)[1]), piece.sizes + 1))
                    held += len(pending[-1][0])
                    if held >= _STREAM:
                        total, held = total + learn(), 0
            if pending:
                total += learn()
            if total:
                flat = net.flat()
                parts = [flat[at : at + _PART].tobytes() for at in range(0, len(flat), _PART)]
                for part, values in enumerate(parts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([values], pa.binary()), pa.array([total], pa.int64())],
                        ["part", "values", "n"],
                    )

        kinds = "part int, values binary, n long"
        # Every task sends all parameters, so there are two tasks a core and not one for every split.
        learning = docs.where(share == number).select(text).coalesce(2 * spark.sparkContext.defaultParallelism)
        made = learning.mapInArrow(run, kinds)
        made = made.withColumn("share", F.spark_partition_id() % _SHARES).groupBy("part", "share").applyInArrow(_mean, kinds)
        rows = made.groupBy("part").applyInArrow(_mean, kinds).collect()
        if rows:
            rows.sort(key=lambda r: r["part"])
            model.load(np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows]))
    return model.flat()


def score_texts(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs``, learning from the rows where ``training`` is true.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's
    probability under the unigram base and under the model). Words are cut at ASCII white space and
    lower-cased in A-Z; every text has one more token, its end, so null and empty texts have one. Without training rows the end is
    unknown and the model is uniform over the entries. Null ids and repeated rows stay and teach as often as they occur.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scores")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("train")
    )
    counts = scratch.store(word_counts(rows, "text", "train"), "counts")
    ends = rows.where("train").count()
    vocabulary = build_vocabulary(counts, ends)
    learning = rows.where("train").select(F.coalesce("text", F.lit("")).alias("text"))
    flat = fit_model(learning, "text", vocabulary)
    words, weights = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        net = Gru(known.entries, OTHERS)
        net.load(weights.value)
        log_counts = np.log10(known.counts + 1.0)
        for batch in batches:
            texts, base, model, sure, offsets, rare, times = [], [], [], [], [0], [], []
            for piece in cut_words(batch.column(1)):
                place, entry = known.code(piece)
                ids, count = known.ids(piece, entry), len(piece.sizes)
                texts += np.split(ids, np.cumsum(piece.sizes + 1)[:-1])
                owner = np.repeat(np.arange(count), piece.sizes)
                each = lambda values, owner=owner, at=piece.at, count=count: np.bincount(owner, values[at], count)
                listed, other = place >= 0, entry >= known.entries
                logs = np.where(listed, log_counts[place], 0.0)
                base.append(each(logs) + math.log10(known.ends + 1.0))
                model.append(each(np.where(other, logs - known.class_log[np.where(other, entry - known.entries, 0)], 0.0)))
                sure.append(each((listed & (known.counts[place] > 0)).astype(float)).astype(np.int64) + (known.ends > 0))
                unlisted = ~listed[piece.at]
                pairs, n = np.unique(owner[unlisted] * len(piece.words) + piece.at[unlisted], return_counts=True)
                who, which = np.divmod(pairs, max(1, len(piece.words)))
                rare += [piece.words[w] for w in which]
                times.append(n)
                offsets += (np.cumsum(np.bincount(who, minlength=count)) + offsets[-1]).tolist()
            if not texts:
                continue
            base, model, sure, times = (np.concatenate(x) for x in (base, model, sure, times))
            score = net.score(texts) / math.log(10) + model
            pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(sure, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(score, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                ["doc_id", "n_tokens", "sure", "base", "model", "rare"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, sure long, base double, model double, rare array<struct<word:binary,times:long>>"
    scored = rows.select("doc_id", "text").mapInArrow(run, schema)
    # The row number is written with the row, so later reads agree on it.
    scored = scratch.store(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    found = scored.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.times")
    taught = counts.where(F.col("n_train") > 0).select("word", "n_train")
    found = found.join(taught, "word").groupBy("row")
    log_count = F.log10(F.col("n_train") + 1.0)
    found = found.agg(F.sum(F.col("times") * log_count).alias("log"), F.sum("times").alias("met"))
    joined = scored.drop("rare").join(found, "row", "left")
    log, met = F.coalesce("log", F.lit(0.0)), F.coalesce("met", F.lit(0))
    log_all = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("sure") + met).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("model") + log).alias("score"),
    )
