"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and runs of white space become one blank. An item of m characters may be found
with k = floor(max_error * m) edits. Cut into k + 1 pieces, at least one piece of any such occurrence
is untouched, so an Aho-Corasick automaton over all pieces finds every candidate place, and Myers'
bit-parallel edit distance verifies the text around it.

Cases: null, empty and blank documents match nothing; items that are null or shorter than
`min_chars` normalised characters are no evidence and are left out; of items with equal text each is
reported; repeated rows are searched one by one; null document ids are carried along; an empty table
on either side gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ERROR = 0.08
MIN_CHARS = 40
#: Normalised item characters that one automaton, and so one broadcast, holds at most.
BLOCK_CHARS = 2_000_000


def normalize(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(text: str, parts: int) -> list[tuple[int, str]]:
    """(offset, piece) of `parts` pieces whose lengths differ by one at most."""
    cuts = [len(text) * i // parts for i in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Edit distance of a pattern to the best-matching substring, one machine-independent bit vector
    per step (Python integers hold patterns of any length)."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.mask = (1 << self.size) - 1
        self.last = 1 << (self.size - 1)
        self.places: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.places[c] = self.places.get(c, 0) | (1 << i)

    def best_end(self, text: str, limit: int) -> tuple[int, int] | None:
        """(distance, end) of the first best match within `limit` edits."""
        vp, vn, score, mask, last = self.mask, 0, self.size, self.mask, self.last
        places, best, at = self.places, limit + 1, -1
        for i, c in enumerate(text):
            eq = places.get(c, 0)
            d0 = (((eq & vp) + vp) ^ vp) | eq | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            if hp & last:
                score += 1
            if hn & last:
                score -= 1
            hp <<= 1
            vp = ((hn << 1) | ~(d0 | hp)) & mask
            vn = hp & d0 & mask
            if score < best:
                best, at = score, i + 1
        return None if at < 0 else (best, at)


class PieceIndex:
    """Automaton over the pieces of a block of items; built once in each task."""

    def __init__(self, items: list[tuple[int, str]], max_error: float):
        import ahocorasick

        self.items = [(item, len(text), int(len(text) * max_error), Myers(text), Myers(text[::-1])) for item, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.items[i][2] + 1):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best match of every item that `text` holds."""
        if not self.items or not text:
            return
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for i, offset in where:
                _, m, k, _, _ = self.items[i]
                begin = last + 1 - size - offset
                low, high = max(0, begin - k), min(len(text), begin + m + k)
                if high - low < m - k:
                    continue
                own = windows.setdefault(i, [])
                if own and low <= own[-1][1]:  # hits come in order: overlapping windows grow together
                    own[-1][0], own[-1][1] = min(own[-1][0], low), max(own[-1][1], high)
                else:
                    own.append([low, high])
        for i, spans in windows.items():
            item, m, k, forward, backward = self.items[i]
            best = None
            for low, high in spans:
                hit = forward.best_end(text[low:high], k if best is None else best[0] - 1)
                if hit:
                    best = (hit[0], low + hit[1])
                    if not best[0]:
                        break
            if best:
                distance, end = best
                reach = max(0, end - m - k)
                start = end - backward.best_end(text[reach:end][::-1], distance)[1]
                yield item, distance, start, end


def find_contamination(docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR,
                       min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """`key`, item_id, distance, start and end (in the normalised text) of each item in each document.

    Items go out in blocks of at most `block_chars` characters, one scan of the documents per
    block, so the broadcast is bounded for benchmarks of any size. No shuffle.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = (f"key {source.schema['key'].dataType.simpleString()}, item_id long, distance int, start int, "
              "`end` int")
    found = None
    for block in _blocks(benchmark, min_chars, block_chars):
        shared = source.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = PieceIndex(shared.value, max_error)
            for batch in batches:
                rows = [(i, *hit) for i, value in enumerate(batch.column(1))
                        for hit in index.search(normalize(value.as_py()))]
                take, *columns = zip(*rows, strict=True) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(take, pa.int64())), pa.array(columns[0], pa.int64()),
                     *(pa.array(c, pa.int32()) for c in columns[1:])], ["key", "item_id", "distance", "start", "end"])

        part = source.mapInArrow(scan, schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("key", key)


def _blocks(benchmark: DataFrame, min_chars: int, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, used = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        item = normalize(row["text"])
        if len(item) < max(min_chars, 1):
            continue
        if block and used + len(item) > block_chars:
            yield block
            block, used = [], 0
        block.append((row["item_id"], item))
        used += len(item)
    yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_error: float = MAX_ERROR, min_chars: int = MIN_CHARS,
                  block_chars: int = BLOCK_CHARS, text: str = "text") -> DataFrame:
    """`docs`, all columns, without the documents that hold a benchmark item. Rows are decided where
    they are: no join, no shuffle."""
    out = docs
    for block in _blocks(benchmark, min_chars, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        out = out.filter(~_holds(shared, max_error)(F.col(f"`{text}`")))
    return out


def _holds(shared, max_error: float):
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = PieceIndex(shared.value, max_error)
        for texts in batches:
            yield pd.Series([next(index.search(normalize(t)), None) is not None for t in texts], dtype=bool)

    return holds
