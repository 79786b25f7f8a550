"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The most frequent words of the corpus are compiled, in sorted order, into an automaton that shares
prefixes and suffixes. Each edge carries the number of words before it, so the sum along a word's
path is the word's place in the sorted list, and through it the word's ids. The arrays are one file
in the shared folder; every executor fetches it and maps it into memory, so that tasks of one
machine share its pages. Words outside the automaton are merged exactly, so the choice of frequent words
changes the time and never the ids.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch, commonest, write_bytes
from verbatide.llm.token_counts import BLOCK, WordBpe

LEXICON_WORDS = 65_536  # most words compiled; bounds the driver's work and the mapped file
CACHED_WORDS = 1 << 17  # per task; a full cache starts anew, which changes no result
_COUNTED = 200_000  # distinct words that a task holds before it passes their counts on
_SLICE = 2 << 20  # bytes of text that a task turns into strings at a time; a longer text is a slice by itself
ENCODED = "n_tokens long, ids binary, decoded string"


class Transducer:
    """The automaton as flat arrays: per state a run of edges sorted by label."""

    FIELDS = (("edge", np.int64), ("target", np.int32), ("before", np.int32), ("final", np.uint8), ("start", np.int64), ("ids", np.uint32))

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, words: Sequence[bytes], ids: Sequence[np.ndarray]) -> Transducer:
        """``words`` must be sorted and distinct. Suffix states are shared as words come in."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((label, state), ...)) of frozen states
        path: list[tuple[bool, list]] = [(False, [])]  # states of the last word, still open

        def freeze(down_to: int) -> None:
            while len(path) - 1 > down_to:
                final, edges = path.pop()
                key = (final, tuple(edges))
                state = register.get(key)
                if state is None:
                    state = register[key] = len(states)
                    states.append(key)
                parent = path[-1][1]
                parent[-1] = (parent[-1][0], state)

        last = b""
        for word in words:
            shared = len(os.path.commonprefix([last, word]))
            freeze(shared)
            for label in word[shared:]:
                path[-1][1].append((label, -1))
                path.append((False, []))
            path[-1] = (True, path[-1][1])
            last = word
        freeze(0)
        states.append((path[0][0], tuple(path[0][1])))
        counts = np.zeros(len(states), np.int64)
        edge, target, before = [], [], []
        for state, (final, edges) in enumerate(states):  # targets have smaller numbers
            seen = int(final)
            for label, to in edges:
                edge.append(state * 256 + label)
                target.append(to)
                before.append(seen)
                seen += int(counts[to])
            counts[state] = seen
        lengths = np.array([0, *map(len, ids)], np.int64)
        flat = np.concatenate(ids) if len(ids) else np.zeros(0)
        return cls(
            edge=np.array(edge, np.int64),
            target=np.array(target, np.int32),
            before=np.array(before, np.int32),
            final=np.array([f for f, _ in states], np.uint8),
            start=np.cumsum(lengths),
            ids=flat.astype(np.uint32),
        )

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, n), t).tobytes() for n, t in self.FIELDS]
        padded = [p + b"\0" * (-len(p) % 8) for p in parts]
        return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(padded)

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        data = np.memmap(path, np.uint8, "r")
        head = 8 * len(cls.FIELDS)
        sizes, at, arrays = struct.unpack(f"<{len(cls.FIELDS)}q", data[:head].tobytes()), head, {}
        for (name, kind), size in zip(cls.FIELDS, sizes):
            arrays[name] = data[at : at + size].view(kind)
            at += size + -size % 8
        return cls(**arrays)

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """Each word's place in the sorted list, -1 for words that are not in it."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        offset = np.cumsum(lengths) - lengths
        state = np.full(len(words), len(self.final) - 1, np.int64)
        place = np.zeros(len(words), np.int64)
        alive = np.arange(len(words)) if len(self.edge) else np.zeros(0, np.int64)
        if not len(self.edge):
            state[:] = -1
        step = 0
        while len(alive):
            alive = alive[lengths[alive] > step]
            wanted = state[alive] * 256 + raw[offset[alive] + step]
            at = np.minimum(np.searchsorted(self.edge, wanted), len(self.edge) - 1)
            good = self.edge[at] == wanted
            state[alive[~good]] = -1
            alive, at = alive[good], at[good]
            state[alive] = self.target[at]
            place[alive] += self.before[at]
            step += 1
        known = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(known, place, -1)


def frequent_words(docs: DataFrame, vocabulary: str, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """(word, n) of the commonest pre-tokens of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = WordBpe(vocabulary), Counter()
        for batch in batches:
            for value in batch.column(0):
                for words in bpe.pieces(value.as_py()):
                    held.update(words)
                if len(held) > _COUNTED:
                    yield _counts(held)
                    held = Counter()
        yield _counts(held)

    counts = docs.select(text).mapInArrow(count, "word string, n long")
    counts = Scratch(docs.sparkSession, "words").store(counts.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    return commonest(counts, most)


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
    )


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts, each slice beginning in another ``_SLICE`` bytes of the batch than the one before."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begins = (np.cumsum(sizes) - sizes) // _SLICE
    cuts = [0, *(np.flatnonzero(np.diff(begins)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))


def compile_lexicon(words: Sequence[str], vocabulary: str) -> Transducer:
    """The transducer of ``words`` with the ids that the vocabulary gives them."""
    bpe = WordBpe(vocabulary)
    listed = sorted({w for w in words if w not in bpe.special}, key=str.encode)
    ids, counts = bpe.merge(listed)
    return Transducer.build([w.encode() for w in listed], np.split(ids, np.cumsum(counts)[:-1]) if listed else [])


class BpeCodec:
    """Encodes texts to ids and ids to texts, on one machine; tasks hold one each."""

    def __init__(self, vocabulary: str, lexicon: Transducer | None = None):
        self.bpe = WordBpe(vocabulary)
        self.lexicon = lexicon
        self.listed = lexicon.ids.astype("<u4").tobytes() if lexicon is not None else b""
        self.names = self.bpe.names
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Find ids of words not met before."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for name, i in self.bpe.special.items():
            self.known[name] = np.uint32(i).tobytes()
        new = list(words.difference(self.known))
        rest = new
        if self.lexicon is not None and new:
            place = self.lexicon.places([w.encode() for w in new])
            found = np.flatnonzero(place >= 0)
            begins, ends = (4 * self.lexicon.start[place[found] + k] for k in (0, 1))
            for i, begin, end in zip(found.tolist(), begins.tolist(), ends.tolist()):
                self.known[new[i]] = self.listed[begin:end]
            rest = [new[i] for i in np.flatnonzero(place < 0).tolist()]
        ids, counts = self.bpe.merge(rest)
        merged, at = ids.astype("<u4").tobytes(), 0
        for word, size in zip(rest, (4 * counts).tolist()):
            self.known[word] = merged[at : at + size]
            at += size

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian 32-bit numbers, decoded text) of each text, in order."""
        pending: list[tuple[int, list[str]]] = []
        ready: dict[int, list[bytes]] = {}

        def flush() -> None:
            self.learn(set().union(*(words for _, words in pending)))
            get = self.known.__getitem__
            for row, words in pending:
                ready.setdefault(row, []).append(b"".join(map(get, words)))
            pending.clear()

        held = after = 0
        for row, text in enumerate(texts):
            for words in self.bpe.pieces(text):
                pending.append((row, words))
                held += len(words)
                if held >= BLOCK:
                    flush()
                    held = 0
            if not pending:
                for done in range(after, row + 1):
                    yield self._joined(ready.pop(done, []))
                after = row + 1
        flush()
        for done in range(after, len(texts)):
            yield self._joined(ready.pop(done, []))

    def _joined(self, parts: list[bytes]) -> tuple[bytes, str]:
        ids = b"".join(parts)
        return ids, self.decode(ids)

    def decode(self, ids: bytes) -> str:
        """The library's form without a decoder: token strings joined by one space."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def publish_lexicon(docs: DataFrame, vocabulary: str, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Count words over all texts, compile the commonest, hand the file to all executors: its name."""
    spark = docs.sparkSession
    words = [r["word"] for r in frequent_words(docs, vocabulary, text, most).collect()]
    path = Scratch(spark, "lexicon").path(f"lexicon-{uuid.uuid4().hex}.bin")
    write_bytes(spark, path, compile_lexicon(words, vocabulary).to_bytes())
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode_texts(
    docs: DataFrame, vocabulary: str, text: str = "text", most: int = LEXICON_WORDS, digests: bool = False
) -> DataFrame:
    """All columns and rows of ``docs`` with ``n_tokens``, ``ids`` (32-bit little-endian) and ``decoded``.

    With ``digests`` the SHA-256 of both as hex, ``ids_sha256`` and ``decoded_sha256``, instead of
    the values. Null and empty texts have no ids and decode to empty text. Columns of ``docs`` with
    the new names are replaced, so a text column called like one of them raises ``ValueError``. Repeated rows and null ids stay,
    and an empty table gives an empty result. Special strings in a text become their special id, as the library does by default.
    """
    lexicon = publish_lexicon(docs, vocabulary, text, most)
    names = ("n_tokens", "ids_sha256", "decoded_sha256") if digests else ("n_tokens", "ids", "decoded")
    types = (pa.int64(), pa.string(), pa.string()) if digests else (pa.int64(), pa.binary(), pa.string())
    kept = docs.drop(*names)
    if text not in kept.columns:
        raise ValueError(f"the text column may not be named {text}")
    carried = [c for c in kept.columns if c != text] if digests else kept.columns
    at, places = kept.columns.index(text), [kept.columns.index(c) for c in carried]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BpeCodec(vocabulary, Transducer.mapped(SparkFiles.get(lexicon)))
        for batch in batches:
            rows = []
            for texts in _slices(batch.column(at)):
                for ids, decoded in codec.encode(texts.to_pylist()):
                    count = len(ids) // 4
                    if digests:
                        rows.append((count, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                    else:
                        rows.append((count, ids, decoded))
            made = [pa.array([r[k] for r in rows], types[k]) for k in range(3)]
            old = [batch.column(i) for i in places]
            yield pa.RecordBatch.from_arrays([*old, *made], [*carried, *names])

    schema = kept.select(*carried).schema
    for name, kind in zip(names, ("long", "string" if digests else "binary", "string")):
        schema = schema.add(name, kind)
    return kept.mapInArrow(encode, schema)


def decode_ids(df: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text of the ids, null for null ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = BpeCodec(vocabulary)
        for batch in batches:
            yield batch.map(codec.decode, na_action="ignore")

    return df.withColumn(name, decode(F.col(ids)))
