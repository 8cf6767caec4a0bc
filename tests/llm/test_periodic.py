"""Runs of words against all periods tried one by one."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quarry.llm import periodic
from quarry.llm.common import table
from quarry.llm.queries import op12_periodic_runs

SMALL = "/root/testdata/sf0.001"


def brute(words, min_length=12):
    """(start, length, period) of all runs: stretches equal to themselves q words on, for the smallest q."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    found = {}
    for q in range(1, len(w) // 2 + 1):
        equal = np.concatenate([[False], w[q:] == w[:-q], [False]])
        steps = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(steps[::2].tolist(), steps[1::2].tolist()):
            length = end - start + q
            if length >= max(min_length, 2 * q):
                # A stretch of a multiple of its smallest period was found with that period before.
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n, letters = rng.randrange(0, 80), rng.choice([1, 2, 2, 3, 4, 9])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = rng.randrange(1, (n - a) // 2 + 2)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        least = rng.choice([2, 3, 4, 7, 12])
        stretches = periodic.repetitive_stretches(np.array(words, np.int64), np.zeros(n, np.int64), least // 2)
        assert periodic.runs_in(words, stretches, least) == brute(words, least)


def test_equal_window_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(periodic, "_ODD", np.uint64(0))  # every window is equal to every other
    words = [1, 2, 3, 4, 5] * 3 + list(range(20, 40)) + [7] * 13
    stretches = periodic.repetitive_stretches(np.array(words), np.zeros(len(words), np.int64), 6)
    assert stretches == [(0, len(words))]
    assert periodic.runs_in(words, stretches, 12) == brute(words)


def test_fibonacci_and_square_rich_words():
    a, b = "x", "xy"
    while len(b) < 700:
        a, b = b, b + a
    words = [ord(c) for c in b]
    assert periodic.runs_in(words, [(0, len(words))], 2) == brute(words, 2)


def test_edge_cases(spark, docs):
    line = "one two three four five six seven"
    texts = ["", None, " \t\n", "a", "go " * 12, "go " * 11, f"{line}\n{line}", f"x {line} {line} y", "é " * 30 + "end",
             "a b " * 5000, f"{line} z " * 3 + "q " * 14, "    " * 12]
    rows = list(enumerate(texts)) + [(4, texts[4]), (None, texts[7])]
    df = docs(rows)
    df = df.withColumn("runs", df.lang).withColumn("key", df.lang).withColumn("collapsed", df.lang)
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(df).collect()]
    want = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((key, len(words), brute(words), collapsed(words, brute(words))))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.find_runs(df.limit(0)).count() == 0


def test_query_over_whole_documents(spark):
    want = {}
    for r in table(spark, SMALL, "documents").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        want[r.doc_id] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                          hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
                          hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    got = op12_periodic_runs(spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert sum(1 for v in want.values() if v[0]) > 10
