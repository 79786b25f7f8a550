"""Token counts by rank-synchronous merging over ragged arrays.

The pre-tokens of a batch of texts lie end to end in one array of symbols. In each round every
pre-token merges all places of its own lowest-ranked pair at once; those without a pair that merges
are finished. Merging all places of one pair together gives what one-by-one merging gives, because
a pair that holds a merged symbol always ranks after the pair that made the symbol.

The vocabulary file is that of the ``tokenizers`` library, byte-level with an end-of-word mark.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space as the library's patterns know it, and its word pattern.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACE + r"\p{L}\p{N}]+")

CACHED_WORDS = 300_000  # per task; a full cache starts anew, which changes no result
BLOCK = 1 << 18  # words of a very long text taken at a time


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, more = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(more)
            more += 1
    return [letters[b] for b in range(256)]


class WordBpe:
    """Vocabulary, pre-tokens and merges of a word-end BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted([*vocab.items(), *self.special.items()], key=lambda x: x[1])
        self.names = [name for name, _ in names]
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = len(names)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest_first)) or "(?!)")

    def pieces(self, text: str | None) -> Iterator[list[str]]:
        """Pre-tokens in order, in blocks; a special string in the text is a piece of its own."""
        at = 0
        for found in self._special.finditer(text or ""):
            yield from self._words(text[at : found.start()])
            yield [found[0]]
            at = found.end()
        yield from self._words(text[at:] if text else "")

    @staticmethod
    def _words(text: str) -> Iterator[list[str]]:
        # One letter at a time, capital sigma has one small form.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if len(text) < BLOCK:
            yield _WORD.findall(text)
            return
        found = _WORD.finditer(text)
        while block := [m[0] for m in islice(found, BLOCK)]:
            yield block

    def merge(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, number of ids of each word)."""
        coded = [w.encode() for w in words]
        lengths = np.array([len(c) for c in coded], np.int64)
        raw = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.first[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_owner, done_symbols, done_at = [], [], []
        place = np.arange(len(symbols))
        while len(symbols):
            pairs = symbols[:-1] * self.size + symbols[1:]
            found = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            inside = (self.keys[found] == pairs) & (owner[:-1] == owner[1:])
            rank = np.where(inside, self.ranks[found], self.size)
            rank = np.append(rank, self.size)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.repeat(lowest, sizes)
            open_ = lowest < self.size
            if not open_.all():
                shut = ~open_
                done_owner.append(owner[shut])
                done_symbols.append(symbols[shut])
                done_at.append(place[shut])
                symbols, owner, place, rank, lowest = (x[open_] for x in (symbols, owner, place, rank, lowest))
                found = np.append(found, 0)[open_]
            else:
                found = np.append(found, 0)
            if not len(symbols):
                break
            hit = rank == lowest
            # In a run of overlapping places only every second one merges, from the left.
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(hit, -1, np.arange(len(hit))))
            hit &= run % 2 == 1
            at = np.flatnonzero(hit)
            symbols[at] = self.made[found[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, place = symbols[keep], owner[keep], place[keep]
        if not done_symbols:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        place = np.concatenate(done_at)
        order = np.argsort(place, kind="stable")
        ids = np.concatenate(done_symbols)[order].astype(np.uint32)
        counts = np.bincount(np.concatenate(done_owner), minlength=len(words))
        return ids, counts


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for every row of ``docs``.

    ``vocabulary`` is a file path that is the same on every machine. Null text is empty text and has
    no tokens; null ids and repeated rows stay as they are; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(vocabulary)
        known: dict[str, int] = {}

        def add_up(pending: list[tuple[int, list[str]]], counts: np.ndarray) -> None:
            if len(known) > CACHED_WORDS:
                known.clear()
            known.update(dict.fromkeys(bpe.special, 1))
            new = list(set().union(*(words for _, words in pending)).difference(known))
            known.update(zip(new, bpe.merge(new)[1].tolist()))
            for row, words in pending:
                counts[row] += sum(map(known.__getitem__, words))

        for batch in batches:
            counts, pending, held = np.zeros(len(batch), np.int64), [], 0
            for row, value in enumerate(batch.column(1)):
                for words in bpe.pieces(value.as_py()):
                    pending.append((row, words))
                    held += len(words)
                    if held >= BLOCK:
                        add_up(pending, counts)
                        pending, held = [], 0
            add_up(pending, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"]
            )

    n_bytes = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), n_bytes.alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
