"""Language identification by prediction with partial matching over bytes.

Each language has a context tree: for contexts of zero to ``ORDER`` bytes, how often each byte
followed. A byte's code length in a language starts at the longest context the tree holds; a byte
not seen there pays the escape (method C: distinct followers over followers plus distinct) and
is looked up one byte shorter, down to a uniform code over all bytes. Statistics are frozen after
training, so the code length depends on the last ``ORDER`` bytes only and is compiled into a table of
(context, byte, language). A text's language is the one that codes all of it shortest.

Counting reads every training text, as grouped sums of byte 4-grams. All contexts met are kept, so code lengths are exact;
a table of more than ``MOST_BYTES`` is refused before anything of it is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import Scratch

ORDER = 3
MOST_BYTES = 512 << 20  # of the compiled table, which every task holds
MAX_LANGUAGES = 200
_GRAMS = 1_000_000  # distinct 4-grams that a task holds before it passes their counts on
UNDEFINED = "und"
_CHUNK = 1 << 20  # bytes scored at a time
_LETTER = regex.compile(r"\p{L}")


def _grams(texts: list[bytes]) -> np.ndarray:
    """The 4-grams ending at each byte; a text begins after zero bytes."""
    if not texts:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(texts), np.uint8).astype(np.uint32)
    grams = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    return grams[raw[3:] != 0]


def gram_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n) over all texts, with A-Z lower-cased; zero bytes only mark a beginning."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                by_lang.setdefault(name, []).append(value.as_py().lower())
            for name, texts in by_lang.items():
                grams, n = np.unique(_grams(texts), return_counts=True)
                if name in held:
                    old, m = held[name]
                    both, where = np.unique(np.concatenate([old, grams]), return_inverse=True)
                    grams, n = both, np.bincount(where, np.concatenate([m, n])).astype(np.int64)
                held[name] = grams, n
            if sum(len(grams) for grams, _ in held.values()) > _GRAMS:
                yield from passed_on(held)
                held = {}
        yield from passed_on(held)

    def passed_on(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for name, (grams, n) in held.items():
            for at in range(0, len(grams), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams[part])), pa.array(grams[part].astype(np.int64)), pa.array(n[part])],
                    ["lang", "gram", "n"],
                )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """``table[state * symbols + symbol]`` holds bits per language; ``states`` maps three symbols to a state."""

    languages: list[str]
    symbol: np.ndarray
    symbols: int
    states: np.ndarray
    table: np.ndarray

    @classmethod
    def compile(cls, languages: list[str], counts: list[pa.Table]) -> LanguageModel:
        """``counts[order]`` holds (lang, context, byte, n): the bytes after each context of that many bytes.

        Works on whole arrays, so the driver holds little beside the table itself.
        """
        orders = [[t[name].to_numpy() for name in ("context", "byte", "n")] for t in counts]
        names = pa.array(languages, pa.string())
        owners = [pc.index_in(t["lang"].cast(pa.string()), names).to_numpy() for t in counts]
        used = np.unique(np.concatenate([np.zeros(1, np.int64), *[byte for _, byte, _ in orders]]))
        symbol = np.zeros(256, np.int64)
        symbol[used] = np.arange(1, len(used) + 1)  # symbol 0: bytes never seen
        size = len(used) + 1
        contexts = [np.unique(context) if k else np.zeros(1, np.int64) for k, (context, _, _) in enumerate(orders)]
        first = np.cumsum([0, *map(len, contexts)])  # shorter contexts come first
        table = np.zeros((int(first[-1]), size, len(languages)), np.float32)
        for j in range(len(languages)):
            above = np.full((1, size), 8.0)  # the rows of the next shorter contexts
            for k, (context, byte, n) in enumerate(orders):
                mine = owners[k] == j
                at = np.searchsorted(contexts[k], context[mine])
                number = len(contexts[k])
                total = np.bincount(at, n[mine], number)
                distinct = np.bincount(at, minlength=number)
                # A context that is met has met its ending too, one byte shorter.
                made = above[np.searchsorted(contexts[k - 1], contexts[k] % (1 << 8 * (k - 1)))] if k else above.copy()
                met = distinct > 0
                made[met] -= np.log2(distinct[met] / (total + distinct)[met])[:, None]
                made[at, symbol[byte[mine]]] = -np.log2(n[mine] / (total + distinct)[at])
                table[first[k] : first[k + 1], :, j] = made
                above = made
        states = np.zeros((size, size, size), np.int32)
        for k in range(1, len(orders)):  # longer contexts overwrite shorter ones
            number = np.arange(first[k], first[k + 1], dtype=np.int32)
            s = [symbol[(contexts[k] >> 8 * i) & 255] for i in range(k)]  # s[0]: the byte just before
            if k == 1:
                states[:, :, s[0]] = number
            elif k == 2:
                states[:, s[1], s[0]] = number
            elif k == 3:
                states[s[2], s[1], s[0]] = number
        return cls(list(languages), symbol, size, states.reshape(-1), table.reshape(len(table) * size, len(languages)))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        if not texts or not self.languages:
            return out
        lengths = np.array([len(t) + ORDER for t in texts], np.int64)
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(b"\0\0\0" + t for t in texts), np.uint8)
        for low in range(ORDER, len(raw), _CHUNK):
            high = min(low + _CHUNK, len(raw))
            s = self.symbol[raw[low - ORDER : high]]
            context = (s[:-3] * self.symbols + s[1:-2]) * self.symbols + s[2:-1]
            bits = self.table[self.states[context].astype(np.int64) * self.symbols + s[3:]]
            owner = np.searchsorted(ends, np.arange(low, high), side="right")
            inside = np.arange(low, high) - (ends - lengths)[owner] >= ORDER
            bits[~inside] = 0
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[owner[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
        return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """A model of the languages of ``docs``; rows with null text or language teach nothing.

    More than ``MAX_LANGUAGES`` languages, or contexts whose table would exceed ``MOST_BYTES``, raise ``ValueError``.
    """
    scratch = Scratch(docs.sparkSession, "language")
    grams = scratch.store(gram_counts(docs, lang, text), "grams")
    totals = {r["lang"]: r["n"] for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    context = lambda order: (F.shiftright(F.col("gram"), 8) % (1 << 8 * order)).cast("long") if order else F.lit(0).cast("long")
    contexts = [F.count_distinct(context(order)).alias(f"c{order}") for order in range(ORDER + 1)]
    facts = grams.agg(F.count_distinct(F.col("gram") % 256).alias("symbols"), *contexts).first()
    size = sum(facts[f"c{order}"] for order in range(ORDER + 1)) * (facts["symbols"] + 1) * max(1, len(totals)) * 4
    if size > MOST_BYTES:
        raise ValueError(f"the languages' contexts need a table of {size} bytes, more than {MOST_BYTES}")
    counts = []
    for order in range(ORDER + 1):
        after = grams.groupBy("lang", context(order).alias("context"), (F.col("gram") % 256).alias("byte"))
        counts.append(after.agg(F.sum("n").alias("n")).toArrow())  # no more rows than the table has cells
    scratch.drop(grams)
    return LanguageModel.compile(sorted(totals), counts)


def _judge(model: LanguageModel, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    names, scores = [UNDEFINED] * len(texts), [0.0] * len(texts)
    rows = [i for i, t in enumerate(texts) if model.languages and _LETTER.search(t)]
    if rows:
        bits = model.code_lengths([texts[i].encode().lower() for i in rows])
        best = bits.argmin(axis=1)
        apart = bits - bits.min(axis=1, keepdims=True)
        share = 1.0 / np.exp2(-np.minimum(apart, 1000)).sum(axis=1)
        for i, b, p in zip(rows, best.tolist(), share.tolist()):
            names[i], scores[i] = model.languages[b], p
    return names, scores


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``.

    ``score`` is the language's share of the probability that all learned languages give the text,
    between 0 and 1. Null texts and texts without a letter are ``und`` with score 0, as is everything
    under a model that has learned nothing. Equal code lengths go to the first language by name.
    Null ids and repeated rows stay. Whole texts are read, in pieces; other columns are not.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(sent.value, [v.as_py() or "" for v in batch.column(1)])
            made = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("lang_pred", "string").add("score", "double"))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows and columns of ``docs`` whose language is found with a score of at least ``least``.

    Null texts and texts without a letter (``und``) go, as does everything under a model that has learned nothing. Repeated
    rows and null ids are judged like others; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(sent.value, [v.as_py() or "" for v in batch.column(at)])
            kept = [name != UNDEFINED and score >= least for name, score in zip(names, scores)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
