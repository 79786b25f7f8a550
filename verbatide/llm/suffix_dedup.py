"""Repeated byte strings by a sparse enhanced suffix array and its common-prefix interval tree.

A byte goes when it lies in a string of ``length`` bytes that also starts elsewhere.

* Of the ``length - k + 1`` strings of ``k`` bytes inside any string of ``length`` bytes, the one of the smallest
  hash (the first of equals) is an *anchor*. Two equal strings have their anchor at the same place, so
  all repeats are found among suffixes that begin at anchors: about one suffix in a hundred.
* The *context* of an anchor is what strings of ``length`` bytes around it can hold. Anchors and contexts are
  counted as hashes. A context that occurs twice is repeated as a whole. Only where one anchor has
  several contexts, one occurrence of each goes on with its bytes.
* The suffixes of one anchor, sorted by Spark, form a stretch of the suffix array. A stack scan over their
  common prefixes gives the intervals of the tree, each with its depth and all its members. Within an interval, members are
  put in the order of the bytes before the anchor, read backwards: neighbours there show how far each member's
  repeat extends to the left and whether the extensions differ, that is whether the repeat is maximal.
* An anchor with more than ``CROWD`` different contexts does not go to one task. Its strings of ``length`` bytes are
  compared by hash over all tasks, first in runs of ``RUNG`` start places by what all strings of
  the run share, then one by one in the runs that repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch
from verbatide.operators.skew import lookup_join

LENGTH = 400
CROWD = 2048  # different contexts of one anchor that are sorted in one task
RUNG = 16
BROADCAST_ROWS = 1_000_000  # chosen occurrences of 32 bytes sent to all tasks; more are joined by a shuffle
SEEN_TEXTS = 1_000_000  # texts a task remembers to have read
_PIECE = 1 << 19

_ONE = np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _ONE


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = _ONE
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    count = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.append(x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


class Anchors:
    """Anchors of texts: (hash, context hash, place)."""

    def __init__(self, length: int):
        self.length, self.k = length, (length + 1) // 2
        size = _PIECE + 4 * length
        self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def __call__(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length, k, total = self.length, self.k, len(raw)
        found = []
        for low in range(0, total - length + 1, _PIECE):  # strings that start in this piece
            base = max(0, low - length)
            part = raw[base : min(total, low + _PIECE + 2 * length)]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[part] * self.up[: len(part)], out=sums[1:])
            stop = min(total, low + _PIECE + length - 1) - base
            begins = np.arange(low - base, stop - k + 1)
            hashes = _mix((sums[begins + k] - sums[begins]) * self.down[begins])
            order = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
            best = (_window_min(order, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            best = best[np.append(True, best[1:] != best[:-1])]
            at = begins[best]
            left, right = np.minimum(at + base, length - k), np.minimum(total - base - at, length)
            around = (sums[at + right] - sums[at - left]) * self.down[at - left]
            shape = (left * (length + 1) + right).astype(np.uint64)
            found.append((hashes[best], _mix(around + _mix(shape * _BASE)), at + base))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        anchors, contexts, at = (np.concatenate(x) for x in zip(*found))
        at, first = np.unique(at, return_index=True)
        return anchors[first], contexts[first], at


def _anchor_table(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, context, th, at) for texts that the task has not seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = Anchors(length), set()
        for batch in batches:
            parts = []
            for th, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if th in seen:
                    continue
                if len(seen) >= SEEN_TEXTS:
                    seen.clear()
                seen.add(th)
                anchors, contexts, at = find(np.frombuffer(value.as_py(), np.uint8))
                parts.append((anchors.view(np.int64), contexts.view(np.int64), np.full(len(at), th, np.int64), at))
            if parts:
                arrays = [pa.array(np.concatenate(x)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "context", "th", "at"])

    return texts.mapInArrow(run, "anchor long, context long, th long, at long")


def common_prefixes(texts: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each text with the next."""
    width = max(map(len, texts), default=0)
    sizes = np.array([len(t) for t in texts])
    table = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
    if not width or len(texts) < 2:
        return np.zeros(max(0, len(texts) - 1), np.int64)
    apart = table[1:] != table[:-1]
    first = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


def intervals(prefixes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(depth, first, end) of the common-prefix intervals of sorted suffixes, inner ones first."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*prefixes.tolist(), -1]):
        first = i
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, i + 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class Group:
    """The suffixes of one anchor, sorted by ``rights``; ``lefts`` are the bytes before it, reversed."""

    def __init__(self, lefts: list[bytes], rights: list[bytes]):
        self.prefixes = common_prefixes(rights)
        order = sorted(range(len(lefts)), key=lefts.__getitem__)
        self.rank = np.empty(len(lefts), np.int64)
        self.rank[order] = np.arange(len(lefts))
        self.shared = common_prefixes([lefts[i] for i in order])

    def maximal_repeats(self, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(depth, members, left, common): an interval's members, how far each one's repeat with another
        member extends to the left, and how far all of them extend alike. Left of that the extensions
        differ, so the repeat of ``common + depth`` bytes with all these occurrences is maximal."""
        for depth, first, end in intervals(self.prefixes):
            if depth < least:
                continue
            members = np.arange(first, end)
            by_left = members[np.argsort(self.rank[members])]
            ranks = self.rank[by_left]
            shared = np.minimum.reduceat(self.shared[: ranks[-1]], ranks[:-1])
            left = np.maximum(np.append(shared, 0), np.append(0, shared))
            yield depth, by_left, left, int(shared.min())


def _group_spans(rows: DataFrame, length: int) -> DataFrame:
    """(th, start, end) of repeats of single contexts, from rows sorted by (anchor, right)."""
    k = (length + 1) // 2

    def spans(rows: list[dict]) -> Iterator[tuple[int, int, int]]:
        if len(rows) < 2:
            return
        group = Group([r["left"][::-1] for r in rows], [r["right"] for r in rows])
        for depth, members, left, _ in group.maximal_repeats(k):
            for i in np.flatnonzero(left + depth >= length):
                row = rows[members[i]]
                if row["single"]:
                    yield row["th"], row["at"] - int(left[i]), row["at"] + depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["anchor"] != row["anchor"]:
                    out.extend(spans(held))
                    held = []
                held.append(row)
            yield _span_batch(out)
        yield _span_batch(list(spans(held)))

    return rows.mapInArrow(run, "th long, start long, end long")


def _span_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["th", "start", "end"])


def _rung_rows(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, context, rung, key): what all strings of a run of start places share."""
    most = length - (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = r["left"], r["right"]
                for rung in range(0, most + 1, RUNG):
                    need = length - min(rung + RUNG - 1, most)
                    if len(left) >= rung and len(right) >= need:
                        key = xxhash.xxh3_64_intdigest(left[len(left) - rung :] + right[:need]) - (1 << 63)
                        out.append((r["anchor"], r["context"], rung, key))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["anchor", "context", "rung", "key"]
            )

    return rows.mapInArrow(run, "anchor long, context long, rung long, key long")


def _string_rows(rows: DataFrame, length: int) -> DataFrame:
    """(th, start, key): the strings of the runs listed in ``rungs``."""
    most = length - (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = r["left"], r["right"]
                for rung in r["rungs"]:
                    for j in range(rung, min(rung + RUNG, most + 1)):
                        if len(left) >= j and len(right) >= length - j:
                            key = xxhash.xxh3_64_intdigest(left[len(left) - j :] + right[: length - j]) - (1 << 63)
                            out.append((r["th"], r["at"] - j, key))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["th", "start", "key"])

    return rows.mapInArrow(run, "th long, start long, key long")


def _crowd_spans(rows: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """As ``_group_spans``, for anchors with very many contexts."""
    repeated = (F.min("context") != F.max("context")).alias("repeated")  # one occurrence per context
    rungs = scratch.store(_rung_rows(rows, length), "rungs")
    run = ["anchor", "rung", "key"]
    shared = rungs.groupBy(*run).agg(repeated, F.count("*").alias("n")).where("repeated")
    # One passage that very many texts hold is one key of this join and the next: such keys are dealt over tasks.
    kept = lookup_join(rungs, shared.select(*run), run, shared.select(*run, "n")).groupBy("anchor", "context")
    kept = rows.join(kept.agg(F.collect_set("rung").alias("rungs")), ["anchor", "context"])
    # A string that holds two anchors comes from both: it repeats when it starts in two places.
    strings = scratch.store(_string_rows(kept, length).distinct(), "strings")
    same = strings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    found = lookup_join(strings, same.select("key"), "key", same)
    return found.select("th", "start", (F.col("start") + length).alias("end"))


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(th, start, end): repeats in ``texts(th, n, raw)``, spans of one text in any order and overlapping.

    ``th`` is a 64-bit hash of the bytes ``raw``, ``n`` their number; rows of one ``th`` are copies.
    """
    spark = texts.sparkSession
    scratch, k = Scratch(spark, "suffixes"), (length + 1) // 2
    long = texts.where(F.col("n") >= length)
    copies = long.groupBy("th").agg(F.count("*").alias("copies"), F.first("n").alias("n"))
    whole = copies.where(F.col("copies") > 1).select("th", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))

    table = scratch.store(_anchor_table(long.select("th", "raw"), length), "anchors")
    place = F.struct("th", "at")
    contexts = table.groupBy("anchor", "context").agg(F.min(place).alias("one"), F.max(place).alias("two"), F.count("*").alias("n"))
    contexts = contexts.withColumn("single", F.col("one") == F.col("two")).select("anchor", "context", "one", "single", "n")
    contexts = scratch.store(contexts, "contexts")

    # Contexts that occur again: every string of them is repeated, at each occurrence.
    twice = contexts.where(~F.col("single")).select("anchor", "context", "n")
    again = lookup_join(table, twice.drop("n"), ["anchor", "context"], twice).select("th", "at")

    # Anchors with several contexts, a single one among them: compare the contexts' bytes.
    several = contexts.groupBy("anchor").agg(F.count("*").alias("m"), F.max(F.col("single").cast("int")).alias("any"))
    several = scratch.store(several.where((F.col("m") > 1) & (F.col("any") == 1)).select("anchor", "m"), "several")
    crowds = several.select("anchor", F.col("m").alias("n"))
    chosen = lookup_join(contexts.drop("n"), several, "anchor", crowds).select("anchor", "context", "single", "m", "one.th", "one.at")
    chosen = scratch.store(chosen, "chosen")
    places = chosen.groupBy("th").agg(F.collect_list(F.struct("anchor", "context", "single", "m", "at")).alias("places"))
    small = chosen.count() <= BROADCAST_ROWS
    marked = long.select("th", "raw").join(F.broadcast(places) if small else places, "th")
    rows = scratch.store(_context_bytes(marked, length).distinct(), "bytes")
    sorted_rows = rows.where(F.col("m") <= CROWD).repartition("anchor").sortWithinPartitions("anchor", "right")
    near = _group_spans(sorted_rows.select("anchor", "single", "th", "at", "left", "right"), length)
    near = near.unionByName(_crowd_spans(rows.where(F.col("m") > CROWD), length, scratch))

    # An occurrence of a repeated context covers its context, cut at the ends of its text.
    sized = again.join(copies.select("th", "n"), "th")
    full = sized.select(
        "th",
        F.greatest(F.col("at") - (length - k), F.lit(0)).cast("long").alias("start"),
        F.least(F.col("at") + length, F.col("n")).cast("long").alias("end"),
    ).where(F.col("end") - F.col("start") >= length)
    found = whole.unionByName(full).unionByName(near)
    lists = found.groupBy("th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return scratch.store(lists, "spans")


def _context_bytes(marked: DataFrame, length: int) -> DataFrame:
    """A row per chosen place with the bytes before (``left``) and from (``right``) its anchor."""
    most = length - (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for th, raw, places in zip(*(batch.column(c) for c in ("th", "raw", "places"))):
                th, raw = th.as_py(), raw.as_py()
                for p in places.as_py():
                    at = p["at"]
                    out.append((p["anchor"], p["context"], p["single"], p["m"], th, at, raw[max(0, at - most) : at], raw[at : at + length]))
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            names = ["anchor", "context", "single", "m", "th", "at", "left", "right"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    schema = "anchor long, context long, single boolean, m long, th long, at long, left binary, right binary"
    return marked.mapInArrow(run, schema)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint and not touching."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(s, e) for s, e in merged]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = True
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and with ``keep_bytes`` ``kept`` (binary).

    Every row of ``docs`` has a row. Texts are UTF-8 bytes; null is empty. Strings are judged on the
    input, may overlap, and do not cross rows; repeated rows repeat each other's strings. ``n_spans`` counts the maximal removed runs. What is
    kept may cut a character in two, so it is bytes. Texts below ``length`` bytes lose nothing. Null ids stay; other columns are not read.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), raw.alias("raw"))
    rows = rows.withColumns({"th": F.xxhash64("raw"), "n": F.octet_length("raw").cast("long")})
    spans = repeated_spans(rows.select("th", "n", "raw"), length)
    counts = rows.groupBy("th").agg(F.count("*").alias("n"))
    joined = lookup_join(rows.select("doc_id", "raw", "th"), spans, "th", counts=counts, how="left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, found in zip(batch.column(1), batch.column(2)):
                data, at, parts = value.as_py(), 0, []
                merged = merge_spans([(s["start"], s["end"]) for s in found.as_py() or ()])
                for start, end in merged:
                    parts.append(data[at:start])
                    at = end
                kept = b"".join([*parts, data[at:]])
                out.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 5 if keep_bytes else 4]
            made = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if keep_bytes else 4]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select("doc_id", "raw", "spans").mapInArrow(run, schema + (", kept binary" if keep_bytes else ""))
