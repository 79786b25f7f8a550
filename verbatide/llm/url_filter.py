"""URL filters: a trie over reversed host labels and path segments, broadcast to the tasks.

A rule is ``host/path``. It fits its host and all subdomains when the URL's path starts with the
rule's path, which may end within a segment. Among fitting rules the longest (host and path
together) wins, whether it allows or blocks; at equal length the longer host, then the block rule.
The trie is at most ``MAX_RULES`` entries, checked before it is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.common import ASCII_LOWER, free_names

MAX_RULES = 500_000
_URL = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")
RESULT = "host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host lower-cased in A-Z; both empty without a ``://``."""
    found = _URL.match(url) if url else None
    return (found[1].translate(ASCII_LOWER), found[2]) if found else ("", "")


@dataclass
class _Segment:
    children: dict[str, _Segment] = field(default_factory=dict)
    tails: dict[int, dict[str, tuple]] = field(default_factory=dict)  # by length of the last piece


@dataclass
class _Label:
    children: dict[str, _Label] = field(default_factory=dict)
    paths: _Segment | None = None


class UrlTrie:
    """``rules`` are (verdict, rule) pairs, the verdict being allow or block."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root, self.depth, count = _Label(), 0, 0
        for verdict, rule in rules:
            count += 1
            if count > MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules are not broadcast")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of {rule!r} is neither allow nor block")
            self._add(verdict, rule)

    def _add(self, verdict: str, rule: str) -> None:
        host, slash, rest = rule.partition("/")
        host = host.translate(ASCII_LOWER)
        node = self.root
        for label in reversed(host.split(".")):
            node = node.children.setdefault(label, _Label())
        node.paths = node.paths or _Segment()
        *whole, tail = (slash + rest).split("/")
        at = node.paths
        for piece in whole:
            at = at.children.setdefault(piece, _Segment())
        self.depth = max(self.depth, len(whole) + 1)
        rank = (len(host) + len(slash + rest), len(host), verdict == "block")
        ends = at.tails.setdefault(len(tail), {})
        entry = (rank, host + slash + rest, verdict)
        ends[tail] = max(ends.get(tail, entry), entry)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fitting rule."""
        best, node, pieces = None, self.root, None
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            if node.paths is None:
                continue
            pieces = path.split("/", self.depth) if pieces is None else pieces
            at = node.paths
            for piece in pieces:
                for length, ends in at.tails.items():
                    entry = ends.get(piece[:length])
                    if entry and (best is None or entry > best):
                        best = entry
                at = at.children.get(piece)
                if at is None:
                    break
        return best and (best[1], best[2])


def filter_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", default: str = "allow"
) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    Rows that no rule fits get a null rule and the ``default`` verdict; so do null URLs and URLs
    without ``://``, whose host and path are empty. Columns of ``pages`` with the names of the new
    ones are replaced; rows are neither dropped nor merged, and an empty table stays empty. More than ``MAX_RULES``
    rules, which every task holds, raise ``ValueError``.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for batch in batches:
            rows = []
            for value in batch:
                host, path = split_url(value)
                rows.append((host, path, *(find(host, path) or (None, default))))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    (found,) = free_names(pages.columns, "judged")
    judged = pages.withColumn(found, judge(F.col(url)))
    names = ("host", "path", "rule", "verdict")
    return judged.withColumns({name: F.col(found)[name] for name in names}).drop(found)
