"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

* The index is one narrow pass over the texts. A task closes a shard after ``SHARD_BYTES`` of text, so shards are bounded and
  nothing is shuffled. A shard numbers its documents by rising length and writes a row per term: the documents in
  blocks of ``BLOCK`` (first document, largest term frequency) and, compressed, the gaps and frequencies. Since a block's
  documents have about one length, its largest frequency and its first length bound all its scores closely.
* Weights need only sums over the index: the documents that hold a term, the documents and terms in all.
* A search sends the queries' terms (in blocks of ``QUERY_TERMS``) to all shards. In a shard a query's lists are taken by
  falling global bound. What is scored so far gives a threshold, the k-th best partial score; once the bounds of all
  lists to come are below it, those lists are non-essential: they add no new candidates. Then the block maxima of the
  non-essential lists are looked up for each candidate, candidates that cannot reach the threshold are rejected, and only blocks with
  candidates left are decompressed. The k best so far and their threshold are carried from shard to shard of
  a task, and the heaps of all tasks are merged.

Scores are integers, so the result does not depend on how the documents are dealt.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from verbatide.llm.common import LOWER, UPPER, Scratch

TOP = 20
BLOCK = 64  # documents of a block
SHARD_BYTES = 16 << 20
QUERY_TERMS = 200_000  # terms of queries that are sent to all tasks at a time
K1_TENTHS, B_PERCENT = 12, 25  # term saturation 1.2, share of the length in it 25 %

# Fixed value: which bytes are no part of a term (ASCII other than letters and digits); A-Z become a-z.
_BREAKS = bytes(i for i in range(128) if not chr(i).isalnum())
_FOLD = bytes.maketrans(UPPER.encode() + _BREAKS, LOWER.encode() + b" " * len(_BREAKS))

INDEX = "shard long, term binary, df long, tokens long, firsts binary, tops binary, gap_bytes int, tf_bytes int, data binary"


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight; grows with ``tf`` and falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + K1_TENTHS * m)


def length_norm(n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    return 100 - B_PERCENT + (B_PERCENT * n * documents) // max(1, tokens)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _planes(values: np.ndarray) -> list[np.ndarray]:
    """The bytes of 32-bit numbers, lowest first."""
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return [raw[:, i] for i in range(4)]


def _width(most: np.ndarray) -> np.ndarray:
    """Bytes that numbers up to ``most`` need, at least one."""
    return 1 + (most > 0xFF).astype(np.int64) + (most > 0xFFFF) + (most > 0xFFFFFF)


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def build_shard(number: int, ids: pa.Array, texts: list[bytes]) -> list[pa.RecordBatch]:
    """The index rows of one shard: first its documents (``term`` null), then its terms.

    ``texts`` are folded, their terms apart by spaces. Documents without terms are left out.
    """
    texts = [t.strip() for t in texts]
    cut = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    sizes = pc.list_value_length(cut).to_numpy()
    held = np.array([len(t) > 0 for t in texts], bool)
    order = np.flatnonzero(held)[np.argsort(sizes[held], kind="stable")]
    lengths = sizes[order].astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    place = np.zeros(len(texts), np.int64)  # the number that a document gets
    place[order] = np.arange(len(order))
    doc = np.repeat(place, sizes)
    term = coded.indices.to_numpy().astype(np.int64)
    keep = np.repeat(held, sizes)
    pairs, tf = np.unique((term[keep] << 32) | doc[keep], return_counts=True)
    term, doc = pairs >> 32, pairs & 0xFFFFFFFF

    begin = np.flatnonzero(np.append(len(term) > 0, np.diff(term) != 0)[: len(term)])
    df = np.diff(np.append(begin, len(term)))
    inside = np.arange(len(term)) - np.repeat(begin, df)
    heads = np.flatnonzero(inside % BLOCK == 0)
    gaps = np.diff(doc, prepend=0)
    gaps[heads] = 0
    blocks = -(-df // BLOCK)
    tops = np.maximum.reduceat(tf, heads) if len(heads) else tf
    gap_bytes = _width(np.maximum.reduceat(gaps, begin)) if len(begin) else df
    tf_bytes = _width(np.maximum.reduceat(tf, begin)) if len(begin) else df
    ends = np.cumsum((gap_bytes + tf_bytes) * df)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    start = np.repeat(ends - (gap_bytes + tf_bytes) * df, df)
    for k, (gap, count) in enumerate(zip(_planes(gaps), _planes(tf))):
        for plane, width, skip in ((gap, gap_bytes, 0), (count, tf_bytes, gap_bytes)):
            used = np.repeat(width > k, df)
            at = start + np.repeat((skip + k) * df, df) + inside
            data[at[used]] = plane[used]

    numbers = lambda x, kind: pa.array(np.asarray(x), kind)
    first = pa.RecordBatch.from_arrays(
        [
            numbers([number], pa.int64()),
            pa.array([None], pa.binary()),
            numbers([len(order)], pa.int64()),
            numbers([int(lengths.sum())], pa.int64()),
            pa.array([b""], pa.binary()),
            pa.array([b""], pa.binary()),
            numbers([0], pa.int32()),
            numbers([0], pa.int32()),
            pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
            pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(ids.type)),
        ],
        _INDEX_NAMES,
    )
    if not len(df):
        return [first]
    names = coded.dictionary.cast(pa.binary()).take(pa.array(term[begin]))
    rows = pa.RecordBatch.from_arrays(
        [
            numbers(np.full(len(df), number), pa.int64()),
            names,
            numbers(df, pa.int64()),
            numbers(np.zeros(len(df), np.int64), pa.int64()),
            _binary(blocks * 4, doc[heads].astype("<u4").view(np.uint8)),
            _binary(blocks * 4, tops.astype("<u4").view(np.uint8)),
            numbers(gap_bytes.astype(np.int32), pa.int32()),
            numbers(tf_bytes.astype(np.int32), pa.int32()),
            _binary((gap_bytes + tf_bytes) * df, data),
            pa.nulls(len(df), pa.list_(ids.type)),
        ],
        _INDEX_NAMES,
    )
    return [first, *(rows.slice(at, 20_000) for at in range(0, len(df), 20_000))]


_INDEX_NAMES = [*(part.split()[0] for part in INDEX.split(", ")), "ids"]


@dataclass
class Index:
    """An index in ``table``, with its documents and terms in all."""

    table: DataFrame
    documents: int
    tokens: int


def build_index(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Index:
    """Index every row of ``docs`` that has a term; each is a document, repeated ids and null ids too."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, made, part = [], [], 0, 0, 0
        for batch in batches:
            part = batch.column(2)[0].as_py() if len(batch) else part
            begin = 0
            for at, value in enumerate(batch.column(1)):
                texts.append(value.as_py().encode("utf-8", "surrogatepass").translate(_FOLD))
                held += len(texts[-1])
                if held >= shard_bytes:
                    ids.append(batch.column(0).slice(begin, at + 1 - begin))
                    yield from build_shard((part << 32) + made, pa.concat_arrays(ids), texts)
                    ids, texts, held, made, begin = [], [], 0, made + 1, at + 1
            ids.append(batch.column(0).slice(begin))
        if texts:
            yield from build_shard((part << 32) + made, pa.concat_arrays(ids), texts)

    kind = rows.schema["doc_id"].dataType.simpleString()
    table = scratch.store(rows.mapInArrow(run, f"{INDEX}, ids array<{kind}>"), "index")
    sums = table.where(F.col("term").isNull()).agg(F.sum("df").alias("n"), F.sum("tokens").alias("t")).first()
    return Index(table, sums["n"] or 0, sums["t"] or 0)


class PostingList:
    """A term's list in one shard; blocks are decompressed when they are asked for."""

    def __init__(self, row: dict, weight: int, norms: np.ndarray):
        self.df, self.weight, self.norms = row["df"], weight, norms
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        self.gap_bytes, self.tf_bytes = row["gap_bytes"], row["tf_bytes"]
        self.data = np.frombuffer(row["data"], np.uint8).reshape(self.gap_bytes + self.tf_bytes, self.df)
        tops = np.frombuffer(row["tops"], "<u4").astype(np.int64)
        # Documents are numbered by length, so a block's first has its smallest norm.
        self.block_bounds = weight * saturation(tops, norms[self.firsts])
        self.bound = int(self.block_bounds.max())
        self.decoded: tuple[np.ndarray, np.ndarray] | None = None

    def _numbers(self, planes: np.ndarray) -> np.ndarray:
        out = planes[0].astype(np.int64)
        for k in range(1, len(planes)):
            out |= planes[k].astype(np.int64) << (8 * k)
        return out

    def postings(self, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the numbered blocks, by rising document; of all when None."""
        if self.decoded is None and (blocks is None or 2 * len(blocks) >= len(self.firsts)):
            self.decoded = self._decode(np.arange(len(self.firsts)))
        return self.decoded if self.decoded is not None else self._decode(blocks)

    def _decode(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = blocks * BLOCK
        sizes = np.minimum(begins + BLOCK, self.df) - begins
        starts = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(begins - starts, sizes)
        part = self.data[:, at]
        walked = np.cumsum(self._numbers(part[: self.gap_bytes]))
        docs = walked + np.repeat(self.firsts[blocks] - walked[starts], sizes)
        return docs, self.weight * saturation(self._numbers(part[self.gap_bytes :]), self.norms[docs])

    def blocks_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that would hold each document, -1 before the first."""
        return np.searchsorted(self.firsts, docs, side="right") - 1


def search_shard(lists: list[tuple[PostingList, int]], documents: int, top: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold all of the shard's ``top`` best with a score of at least ``threshold``.

    ``lists`` are a query's lists with the number of times the query holds the term.
    """
    lists = sorted(lists, key=lambda x: -x[0].bound * x[1])
    ahead = np.cumsum([0] + [p.bound * times for p, times in lists[::-1]])[::-1]  # bounds of the lists from i on
    scores = np.zeros(documents, np.int64)
    essential = 0
    while essential < len(lists) and ahead[essential] >= max(threshold, 1):
        postings, times = lists[essential]
        docs, found = postings.postings()
        scores[docs] += times * found
        essential += 1
        if essential < len(lists) and documents > top:
            # The k-th best partial score; documents that only later lists hold cannot exceed their bounds.
            threshold = max(threshold, int(np.partition(scores, documents - top)[documents - top]))
    docs = np.flatnonzero((scores > 0) & (scores + ahead[essential] >= threshold))
    kept = scores[docs]
    rest = lists[essential:]
    if rest and len(docs):
        limits = np.zeros((len(rest) + 1, len(docs)), np.int64)  # what lists from i on can add, by their block maxima
        places = []
        for i in range(len(rest) - 1, -1, -1):
            postings, times = rest[i]
            block = postings.blocks_of(docs)
            places.append(block)
            limits[i] = limits[i + 1] + np.where(block >= 0, times * postings.block_bounds[block], 0)
        places.reverse()
        live = np.flatnonzero(kept + limits[0] >= threshold)
        for i, (postings, times) in enumerate(rest):
            wanted = places[i][live]
            blocks = np.unique(wanted[wanted >= 0])
            if len(blocks):
                inside, found = postings.postings(blocks)
                at = np.minimum(np.searchsorted(inside, docs[live]), len(inside) - 1)
                kept[live] += np.where(inside[at] == docs[live], times * found[at], 0)
            live = live[kept[live] + limits[i + 1][live] >= threshold]
        docs, kept = docs[live], kept[live]
    good = kept >= max(threshold, 1)
    return docs[good], kept[good]


def _id_key(value: object) -> tuple:
    """Sorts ids by value, null ones first."""
    return (False,) if value is None else (True, value)


class Heaps:
    """The ``top`` best (score, id) of each query; equal scores by rising id, null ids first."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.best: list[list[tuple[tuple, object]]] = [[] for _ in range(queries)]

    def threshold(self, query: int) -> int:
        held = self.best[query]
        return -held[-1][0][0] if len(held) == self.top else 0

    def add(self, query: int, ids: list, ranks: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        if not len(docs):
            return
        order = np.lexsort((ranks[docs], -scores))[: self.top]
        found = [((-int(scores[i]), *_id_key(ids[docs[i]])), ids[docs[i]]) for i in order]
        self.best[query] = sorted(self.best[query] + found, key=lambda x: x[0])[: self.top]


def _search_block(index: Index, queries: list[tuple[object, dict[bytes, int]]], top: int) -> DataFrame:
    """(number, doc_id, score): the best documents of each task for queries that are at hand on the driver."""
    spark = index.table.sparkSession
    terms = sorted({t for _, q in queries for t in q})
    wanted = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in terms], "term binary"))  # at most QUERY_TERMS
    lists = index.table.join(wanted, "term", "left_semi")
    df = {bytes(r["term"]): r["df"] for r in lists.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    weights = {t: term_weight(index.documents, n) for t, n in df.items()}
    sent = spark.sparkContext.broadcast(([q for _, q in queries], weights))
    documents, tokens = index.documents, index.tokens
    kind = index.table.schema["ids"].dataType.elementType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = sent.value
        heaps = Heaps(len(asked), top)
        shard, ids, ranks, norms = None, [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: dict[bytes, PostingList] = {}

        def finish() -> None:
            for number, query in enumerate(asked):
                lists = [(held[t], times) for t, times in query.items() if t in held]
                if lists:
                    heaps.add(number, ids, ranks, *search_shard(lists, len(ids), top, heaps.threshold(number)))

        for batch in batches:
            for row in batch.to_pylist():
                if row["term"] is None:
                    finish()
                    shard, ids, held = row["shard"], row["ids"], {}
                    norms = length_norm(np.frombuffer(row["data"], "<i8"), documents, tokens)
                    order = sorted(range(len(ids)), key=lambda i: _id_key(ids[i]))
                    ranks = np.empty(len(ids), np.int64)
                    ranks[order] = np.arange(len(ids))
                elif row["shard"] == shard:
                    held[row["term"]] = PostingList(row, weight[row["term"]], norms)
        finish()
        found = [(q, doc, -key[0]) for q, best in enumerate(heaps.best) for key, doc in best]
        numbers, docs, scores = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(docs, id_type), pa.array(scores, pa.int64())], ["number", "doc_id", "score"]
        )

    rows = index.table.where(F.col("term").isNull()).unionByName(lists.select(*index.table.columns))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "term")  # nulls first: a shard's documents come before its terms
    return rows.mapInArrow(run, f"number int, doc_id {kind.simpleString()}, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = SHARD_BYTES,
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best rows of ``docs`` for each row of ``queries``.

    A score sums the weights of the query's terms, repeats included, times their saturated frequency in the document;
    only scores above 0 are results. Equal scores go by rising id, null ids first. Null and empty texts have no terms: such
    documents count nowhere, such queries have no rows. Repeated rows of ``docs`` are documents of their own. Rows of one ``item_id`` with different
    texts are searched as one query with all their terms, repeated rows too; null items likewise. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index = build_index(docs, scratch, doc_id, text, shard_bytes)
    kind = queries.schema[item_id].dataType.simpleString()

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [Counter(terms_of(v.as_py())) for v in batch.column(1)]
            pairs = [list(c.items()) for c in counted]
            kinds = pa.list_(pa.struct([("term", pa.binary()), ("times", pa.int64())]))
            made = pa.array([[{"term": t, "times": n} for t, n in p] for p in pairs], kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["item_id", "terms"])

    asked = queries.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    asked = asked.mapInArrow(count_terms, f"item_id {kind}, terms array<struct<term:binary,times:long>>")
    asked = scratch.store(asked.where(F.size("terms") > 0), "queries")
    sized = asked.groupBy("item_id").agg(F.sum(F.size("terms")).alias("n"))
    total = sized.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = -(-total // query_terms)
    results = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        merged: dict[object, Counter] = {}
        for row in mine.toLocalIterator():
            held = merged.setdefault(row["item_id"], Counter())
            for term in row["terms"]:
                held[bytes(term["term"])] += term["times"]
        if not merged:
            continue
        known = list(merged.items())
        found = scratch.store(_search_block(index, known, top), "heaps")
        best = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc("doc_id")))
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(known)], f"number int, item_id {kind}")
        ranked = found.withColumn("rank", best).where(F.col("rank") <= top).join(F.broadcast(names), "number")
        results.append(ranked.select("item_id", "rank", "doc_id", "score"))
    scratch.drop(index.table, asked)
    if not results:
        none = docs.select(F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("rank"), F.col(doc_id).alias("doc_id"))
        return none.withColumn("score", F.lit(0).cast("long")).where(F.lit(False))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
