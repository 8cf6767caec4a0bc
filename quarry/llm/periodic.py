"""Runs of periodic words: maximal stretches that repeat with a period, found on a suffix automaton.

A run is a maximal stretch of words of one text in which words `period` apart are equal, with the smallest
such period and a length of at least `min_length` and twice the period.

Method. The suffix automaton of the words is built; its link tree is then accessed once for every prefix, in
order: the path from the prefix's state to the root is recoloured with the prefix's end. A stretch of the
path that had one colour holds the suffixes whose last occurrence ended there; if the distance from that end
to the new one is the length of one of those suffixes, that suffix and its last occurrence touch: a
square, whose root is primitive as no later occurrence exists. Squares are extended to runs. Preferred paths
are kept as stacks of coloured stretches along the heavy paths of the (finished, so static) link tree, which
bounds an access by O(log n) heavy paths and makes all recolouring O(n log n).

Only stretches of words that can hold a run reach the automaton: every word of a run lies in a window of
min_length / 2 words that occurs again inside the run, so words of no repeated window cannot belong to one.
Windows are compared by hash; equal hashes only let more words through.

Cases: null, empty and blank texts have no words and no runs; equal rows and null keys are judged one by
one; an empty table gives an empty result; only the two named columns are read, so other columns cannot
clash. A task holds one text's automaton at a time: memory follows the longest repetitive stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import spans

MIN_LENGTH = 12
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(31)


class Automaton:
    """Suffix automaton of a sequence: per state its longest length, suffix link and transitions."""

    def __init__(self, words: list[int]):
        self.length, self.link = [0], [-1]
        self.prefix_states: list[int] = []
        follow: list[dict[int, int]] = [{}]
        length, link = self.length, self.link
        last = 0
        for word in words:
            state = len(length)
            length.append(length[last] + 1)
            link.append(0)
            follow.append({})
            at = last
            while at >= 0 and word not in follow[at]:
                follow[at][word] = state
                at = link[at]
            if at >= 0:
                target = follow[at][word]
                if length[target] != length[at] + 1:
                    copy = len(length)
                    length.append(length[at] + 1)
                    link.append(link[target])
                    follow.append(dict(follow[target]))
                    link[target] = copy
                    while at >= 0 and follow[at].get(word) == target:
                        follow[at][word] = copy
                        at = link[at]
                    target = copy
                link[state] = target
            self.prefix_states.append(state)
            last = state


def heavy_heads(length: list[int], link: list[int]) -> list[int]:
    """For every state the top of its heavy path in the link tree."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size = [1] * len(length)
    heavy = [-1] * len(length)
    for state in reversed(order[1:]):
        parent = link[state]
        size[parent] += size[state]
        if heavy[parent] < 0 or size[state] > size[heavy[parent]]:
            heavy[parent] = state
    head = list(range(len(length)))
    for state in order[1:]:
        parent = link[state]
        if heavy[parent] == state:
            head[state] = head[parent]
    return head


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(last word, period) of every primitive square's end that an access finds, by last word."""
    automaton = Automaton(words)
    length, link = automaton.length, automaton.link
    head = heavy_heads(length, link)
    stacks: dict[int, list[tuple[int, int]]] = {}
    for end, state in enumerate(automaton.prefix_states):
        while state > 0:
            top = head[state]
            reach = length[state]
            above = length[link[top]] if top else 0
            stack = stacks.get(top)
            if stack is None:
                stack = stacks[top] = []
            # From the root down: stretches of one colour, each with its longest length.
            while stack and stack[-1][0] <= reach:
                longest, before = stack.pop()
                if above < end - before <= longest:
                    yield end, end - before
                above = longest
            if stack and above < end - stack[-1][1] <= reach:
                yield end, end - stack[-1][1]
            stack.append((reach, end))
            state = link[top] if top else 0


def runs_in(words: list[int], stretches: list[tuple[int, int]], min_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of `words`, which lie inside the stretches, by start and period."""
    found = []
    for begin, end in stretches:
        covered: dict[int, int] = {}  # period -> last word of its latest run
        for last, period in squares(words[begin:end]):
            last += begin
            if covered.get(period, -1) >= last:
                continue
            left = last - 2 * period + 1
            while left > 0 and words[left - 1] == words[left - 1 + period]:
                left -= 1
            right = last
            while right + 1 < len(words) and words[right + 1] == words[right + 1 - period]:
                right += 1
            covered[period] = right
            if right - left + 1 >= min_length:
                found.append((left, right - left + 1, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repetitive_stretches(words: np.ndarray, group: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(begin, end) of the maximal stretches of words, inside a group, that lie in repeated windows.

    Stretches that are found become the groups of the next round, until nothing falls away.
    """
    group = group.astype(np.int64)
    alive = len(words) + 1
    while True:
        n = len(words) - window + 1
        if n <= 0:
            return []
        whole = np.flatnonzero((group[:n] == group[window - 1:]) & (group[:n] >= 0))
        key = group[whole].astype(np.uint64)
        for k in range(window):
            key = (key ^ words[whole + k].astype(np.uint64)) * _ODD
            key ^= key >> _BITS
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        repeated = np.zeros(len(whole), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, whole[repeated], 1)
        np.add.at(depth, whole[repeated] + window, -1)
        covered = np.cumsum(depth[:-1]) > 0
        edge = np.ones(len(words), bool)
        edge[1:] = (covered[1:] != covered[:-1]) | (group[1:] != group[:-1])
        begins = np.flatnonzero(edge & covered)
        if covered.sum() == alive:
            ends = np.append(np.flatnonzero(edge), len(words))
            return list(zip(begins.tolist(), ends[np.searchsorted(ends, begins, "right")].tolist()))
        alive = covered.sum()
        group = np.where(covered, np.cumsum(edge), -1)


def find_runs(df: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """`key`, n_words, runs (array of start, length, period; by start, then period) and collapsed (the words
    that no run holds after its first period, joined by one space) of every row's whole text."""
    if min_length < 2:
        raise ValueError("a run has two words at least")
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def block(data: np.ndarray, edges: np.ndarray) -> tuple[list, list, list]:
        starts, sizes, owner_text = spans.word_spans(_GAP[data], edges)
        words = spans.insert_spans(spans.pad(data), starts, sizes)
        first = np.searchsorted(owner_text, np.arange(len(edges)))
        stretches: dict[int, list[tuple[int, int]]] = {}
        for begin, end in repetitive_stretches(words, owner_text, min_length // 2):
            row = int(owner_text[begin])
            stretches.setdefault(row, []).append((begin - int(first[row]), end - int(first[row])))
        raw = data.tobytes()
        runs, collapsed = [], []
        for row in range(len(edges) - 1):
            parts = raw[edges[row]:edges[row + 1]].split()  # at the six ASCII white spaces
            mine = runs_in(words[first[row]:first[row + 1]].tolist(), stretches[row], min_length) \
                if row in stretches else []
            if mine:
                gone = np.zeros(len(parts) + 1, np.int64)
                for start, length, period in mine:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                parts = [parts[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
            collapsed.append(b" ".join(parts))
        return np.diff(first), runs, collapsed

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, edges in spans.text_blocks(batch.column(1)):
                n_words, runs, collapsed = block(data, edges)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(runs)), pa.array(n_words, pa.int64()), pa.array(runs, run_type),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], ["key", "n_words", "runs", "collapsed"])

    return source.mapInArrow(
        search, f"key {key_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                "collapsed string").withColumnRenamed("key", key)
