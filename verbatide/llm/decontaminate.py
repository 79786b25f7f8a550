"""Benchmark decontamination by spaced seeds.

Fixed masks pick some of the word positions of a window and ignore the rest. Hashes of the picked
words of every window of the benchmark are joined with those of every window of the texts. A hit
fixes an alignment of an item with a text, which is then compared word by word: the pair is reported
when some stretch of ``window`` aligned words (the whole item, if shorter) has at least ``share`` of
its words equal, so a passage is found although words in it were replaced. With the default masks
every such stretch of 13 words holds a hit wherever its two other words are; items of fewer words have masks of
their own, with the same property for 8 to 12 words. Items of fewer than ``SPACED_WORDS`` words have one mask, all their
words, and are found only word for word.

SQL functions only. Window hashes of the texts are made within one generated stage and probe the
broadcast seeds there, so neither texts nor windows are shuffled; only aligned stretches of hits are. The seeds of a
large benchmark are joined by a shuffle of (row, place, seed), and the words come back by the row of a hit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import LOWER, UPPER, free_names

MASKS = ((0, 1, 4, 6, 7), (0, 1, 3, 7, 8))
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 3, 4))  # for items shorter than the window
WINDOW = 13
SPACED_WORDS = 8  # shorter items are found word for word only
SHARE = (4, 5)
BROADCAST_WORDS = 1_000_000  # benchmark words up to which its seeds are broadcast


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word, words being lower-cased in A-Z and cut at ASCII white space."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x20\\x09-\\x0D]+", -1)
    return F.transform(F.filter(cut, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, words: str, place: str, keep: Sequence[str], masks: Sequence[tuple[int, Sequence[int]]]) -> DataFrame:
    """A row per window and numbered mask: ``place`` and the hash ``seed``."""
    at = F.explode_outer(F.sequence(F.lit(0), F.size(words) - 1)).alias(place)
    placed = rows.where(F.size(words) > 0).select(*keep, words, at)
    hashes = []
    for number, mask in masks:
        picked = [F.get(F.col(words), F.col(place) + offset) for offset in mask]
        # A window that runs over the end has no word there.
        hashes.append(F.when(picked[-1].isNotNull(), F.xxhash64(F.lit(number), *picked)))
    return placed.select(*keep, words, place, F.explode(F.array(*hashes)).alias("seed")).where(F.col("seed").isNotNull())


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: Sequence[Sequence[int]] = MASKS,
    short_masks: Sequence[Sequence[int]] = SHORT_MASKS,
    window: int = WINDOW,
    share: tuple[int, int] = SHARE,
) -> DataFrame:
    """(doc_id, item_id, n_equal, n_window, first_word): benchmark items found in documents.

    One row per document and item: the best stretch, the earliest in the text among equals, with
    its number of equal words and its first word's place in the text. Null and empty
    texts have no rows, nor have items without words; an item of fewer than ``SPACED_WORDS`` words is found where all of them stand
    together. Rows with one id are one document, null ids too; of repeated item ids each text counts. Empty tables give an empty
    result. Other columns are not read.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), word_hashes(F.col(item_text)).alias("item"))
    items = items.where(F.size("item") > 0).distinct()
    size = F.size("item")
    whole = F.collect_set(F.when(size < SPACED_WORDS, size)).alias("whole")
    short = size.between(SPACED_WORDS, window - 1)
    facts = items.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n"), F.count_if(short).alias("short"), whole).first()
    small = facts["n"] <= BROADCAST_WORDS
    usual = list(enumerate(masks))
    groups = [(size >= window, usual)]
    if facts["short"]:
        groups.append((short, list(enumerate(short_masks, len(masks)))))
    groups += [(size == m, [(len(masks) + len(short_masks) + m, range(m))]) for m in sorted(facts["whole"])]
    parts = [_seeds(items.where(chosen), "item", "item_at", ["item_id"], used) for chosen, used in groups]
    seeds = reduce(DataFrame.unionByName, parts)
    seeds = seeds.select("item_id", "item_at", "seed", F.xxhash64("item").alias("same"), F.size("item").alias("m")).distinct()
    cut = docs.select(F.col(doc_id).alias("doc_id"), word_hashes(F.col(text)).alias("words"))
    all_masks = [mask for _, used in groups for mask in used]
    if small:
        hits = _seeds(cut, "words", "at", ["doc_id"], all_masks).join(F.broadcast(seeds), "seed")
    else:
        cut = cut.withColumn("row", F.xxhash64("doc_id", "words"))
        narrow = _seeds(cut, "words", "at", ["row"], all_masks).select("row", "at", "seed")
        hits = narrow.join(seeds, "seed").join(cut, "row")
    # Item word j lies at text word start + j; the words between are cut out here, where both are at hand.
    start = (F.col("at") - F.col("item_at")).alias("start")
    first = F.greatest(F.lit(0), F.col("item_at") - F.col("at"))
    stretch = F.slice(F.col("words"), F.col("at") - F.col("item_at") + first + 1, F.col("m") - first)
    aligned = hits.select("doc_id", "item_id", "same", start, first.alias("first"), stretch.alias("stretch"))
    aligned = aligned.groupBy("doc_id", "item_id", "same", "start", "first", "stretch").agg(F.lit(1).alias("_one"))
    lists = items.select("item_id", F.xxhash64("item").alias("same"), "item")
    lists = lists.withColumnRenamed("item_id", "_item").withColumnRenamed("same", "_same")
    found = aligned.join(
        F.broadcast(lists) if small else lists, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("same") == F.col("_same"))
    )
    pair = F.zip_with(
        F.col("stretch"), F.slice("item", F.col("first") + 1, F.size("stretch")), lambda x, y: (x == y).cast("int")
    )
    width = F.least(F.lit(window), F.size("item"))
    found = found.withColumn("equal", pair).withColumn("n_window", width).where(F.size("equal") >= F.col("n_window"))
    count = lambda i: F.aggregate(F.slice("equal", i + 1, F.col("n_window")), F.lit(0), lambda a, x: a + x)
    begins = F.sequence(F.lit(0), F.size("equal") - F.col("n_window"))
    best = F.array_max(F.transform(begins, lambda i: F.struct(count(i).alias("n"), (-(F.col("start") + F.col("first") + i)).alias("w"))))
    found = found.withColumn("best", best).where(F.col("best.n") * share[1] >= F.col("n_window") * share[0])
    top = F.max(F.struct(F.col("best.n").alias("n"), F.col("n_window"), F.col("best.w").alias("w"))).alias("top")
    return found.groupBy("doc_id", "item_id").agg(top).select(
        "doc_id",
        "item_id",
        F.col("top.n").alias("n_equal"),
        F.col("top.n_window").alias("n_window"),
        (-F.col("top.w")).alias("first_word"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` whose id is that of no document in which a benchmark item is found.

    Rows with one id stay or go together, null ids too. Null and empty texts hold no item and stay; empty tables change nothing.
    """
    (leak,) = free_names(docs.columns, "leak")
    leaks = find_leaks(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(leaks, docs[doc_id].eqNullSafe(leaks[leak]), "left_anti")
