"""URL allow/block lists as a trie over reversed host labels and path segments.

Cases: a null url, or one without ``://``, has an empty host and path and gets the default verdict;
repeated rows are judged one by one; an empty table gives an empty result; only the url and the
columns named in `keep` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`host` covers itself and its subdomains; `path` is a literal prefix of the url's path."""

    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> tuple[int, int, bool]:
        """Longest text wins, then the longer host, then block over allow."""
        return len(self.text), len(self.host), self.verdict == BLOCK


@dataclass
class _PathNode:
    children: dict[str, "_PathNode"] = field(default_factory=dict)
    #: last, possibly cut-off segment of a rule -> rule
    tails: dict[str, Rule] = field(default_factory=dict)


@dataclass
class _HostNode:
    children: dict[str, "_HostNode"] = field(default_factory=dict)
    any_path: Rule | None = None
    paths: _PathNode | None = None


class UrlTrie:
    """Host labels from the right, then path segments from the left."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _HostNode()
        for rule in rules:
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")):
            node = node.children.setdefault(label, _HostNode())
        if not rule.path:
            node.any_path = _better(node.any_path, rule)
        elif rule.path.startswith("/"):
            *full, tail = rule.path[1:].split("/")
            place = node.paths = node.paths or _PathNode()
            for segment in full:
                place = place.children.setdefault(segment, _PathNode())
            place.tails[tail] = _better(place.tails.get(tail), rule)
        # Another first character can't begin a url's path, so such a rule never fits.

    def find(self, host: str, path: str) -> Rule | None:
        """The winning rule of one url."""
        best, node = None, self.root
        segments = path[1:].split("/") if path.startswith("/") else None
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            best = _better(best, node.any_path)
            if segments is not None and node.paths is not None:
                best = self._walk(node.paths, segments, best)
        return best

    @staticmethod
    def _walk(place: _PathNode, segments: list[str], best: Rule | None) -> Rule | None:
        for segment in segments:
            for size in {len(t) for t in place.tails}:
                best = _better(best, place.tails.get(segment[:size]) if len(segment) >= size else None)
            place = place.children.get(segment)
            if place is None:
                return best
        return best


def _better(a: Rule | None, b: Rule | None) -> Rule | None:
    if a is None or b is None:
        return a or b
    return b if b.rank > a.rank else a


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _blocks(rules: list[Rule], max_chars: int) -> Iterator[list[Rule]]:
    block, used = [], 0
    for rule in rules:
        if block and used + len(rule.text) > max_chars:
            yield block
            block, used = [], 0
        block.append(rule)
        used += len(rule.text) + 64
    yield block


def _matcher(trie: Broadcast):
    @F.pandas_udf("text string, verdict string, len int, host_len int, block boolean")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.find(h, p) for h, p in zip(host, path, strict=True)]
        rows = [(r.text, r.verdict, *r.rank) if r else (None, None, None, None, None) for r in found]
        return pd.DataFrame(rows, columns=["text", "verdict", "len", "host_len", "block"]).astype(
            {"len": "Int32", "host_len": "Int32", "block": "boolean"})

    return match


def judge_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", keep: tuple[str, ...] = (),
               default: str = ALLOW, max_trie_chars: int = 32_000_000) -> DataFrame:
    """`keep` columns plus host, path, rule (text of the winning rule or null) and verdict.

    A trie of at most `max_trie_chars` rule characters is broadcast. A longer list is cut into
    blocks of that size; each block's trie is applied in turn and the better match is kept, so
    what one task holds at a time stays bounded however long the list is. No shuffle.
    """
    spark = df.sparkSession
    out = df.select(*keep, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    best = None
    for block in _blocks(list(rules), max_trie_chars):
        match = _matcher(spark.sparkContext.broadcast(UrlTrie(block)))
        out = out.withColumn("__new", match("host", "path"))
        if best is None:
            out = out.withColumnRenamed("__new", "__best")
            best = F.col("__best")
        else:
            rank = [F.struct(F.coalesce(F.col(f"{c}.len"), F.lit(-1)), F.col(f"{c}.host_len"), F.col(f"{c}.block"))
                    for c in ("__new", "__best")]
            out = out.withColumn("__best", F.when(rank[0] > rank[1], F.col("__new")).otherwise(best)).drop("__new")
    return out.select(*keep, "host", "path", F.col("__best.text").alias("rule"),
                      F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"))
