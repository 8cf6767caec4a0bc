"""The filter audit against plain Python, on edge cases and on the small documents."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa

from quarry.llm import filter_audit, spans
from quarry.llm.common import table
from quarry.llm.queries import op13_filter_audit

SMALL = "/root/testdata/sf0.001"


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    seen = []
    for key, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
            ("E", key is not None and first[text] < key)) if bad}
        good = any(k == key and q == 1 for k, q, _ in labels if key is not None)
        toxic = any(k == key and t == 1 for k, _, t in labels if key is not None)
        seen.append((source or "", fails, good, toxic))
    out, shapley = [], Counter()
    for part in {s[0] for s in seen}:
        mine = [s for s in seen if s[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                lost, redundant = [s for s in left if f in s[1]], [s for s in gone if f in s[1]]
                left = [s for s in left if f not in s[1]]
                gone = gone + lost
                shapley[part, f] += len(lost)
                out.append([part, order, step, len(left), len(lost), len(redundant),
                            sum(s[1] == {f} for s in mine), sum(s[2] for s in lost), sum(s[3] for s in lost)])
    return sorted(tuple(r) + (shapley[r[0], r[1][r[2] - 1]],) for r in out)


def rows_of(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                          "good_lost", "toxic_lost", "shapley"]
    return sorted(map(tuple, df.collect()))


def test_edge_cases(spark):
    words = " ".join(f"w{i}" for i in range(220))
    rows = [(5, words, "a"), (3, words, "a"), (3, words, "b"), (None, words, "a"), (None, None, None), (9, None, "a"),
            (10, "", ""), (11, "#", "b"), (12, "ABC é日", "a"), (13, "x y " * 300, "a"), (14, "x\ty\x0bx", "c"),
            (15, words + " X" * 30, "b"), (15, words + " X" * 30, "b"), (16, " \n", "c"), (17, "ab" * 90000, "c")]
    labels = [(5, 1, 0), (5, 0, 1), (3, 1, 1), (None, 1, 1), (12, None, 1), (99, 1, 1)]
    docs = spark.createDataFrame([r + (0,) for r in rows], "doc_id long, text string, source string, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert rows_of(filter_audit.filter_interactions(docs, marks)) == brute(rows, labels)
    assert rows_of(filter_audit.filter_interactions(docs.limit(0), marks)) == []


def test_one_text_shared_by_most_rows(spark):
    rows = [(i, "same words here", f"s{i % 3}") for i in range(400)] + [(1000 + i, f"other {i}", "s1") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(16)
    marks = spark.createDataFrame([(0, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    assert rows_of(filter_audit.filter_interactions(docs, marks)) == brute(rows, [(0, 1, 0), (7, 1, 1)])


def test_hash_table_tells_words_apart_when_hashes_collide(monkeypatch):
    texts = pa.array(["aa bb aa cc", None, "bb  bb", "abcdefgh abcdefghi abcdefgh\0 abcdefghi"])
    monkeypatch.setattr(spans, "hash_spans", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
    (_, data, edges), = spans.text_blocks(texts)
    assert filter_audit.scan_block(data, edges)["n_distinct"].tolist() == [3, 0, 1, 3]


def test_query_over_whole_documents(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SMALL, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in table(spark, SMALL, "labels").collect()]
    assert rows_of(op13_filter_audit(spark, SMALL)) == brute(rows, labels)
