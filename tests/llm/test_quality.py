import math
import re
from collections import Counter

import pytest
import xxhash

from quarry.llm import quality as Q
from quarry.llm.common import WORD

SF = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def word_hash(w):
    return signed(xxhash.xxh64_intdigest(w.encode(), 42))


def pair_hash(a, b):
    """xxhash64 of two longs: the second hashed with the first's hash as seed."""
    seed = 42
    for v in (a, b):
        seed = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return signed(seed)


def base(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def grams(text, buckets):
    h = [word_hash(w) for w in re.findall(WORD, text or "")]
    return [x % buckets for x in h] + [pair_hash(a, b) % buckets for a, b in zip(h, h[1:])]


def brute(rows, good, buckets=Q.BUCKETS, threshold=Q.THRESHOLD):
    corpus, trusted = Counter(), Counter()
    for i, t in rows:
        g = grams(t, buckets)
        corpus.update(g)
        if i in good:
            trusted.update(g)
    n1, n0 = sum(trusted.values()) + buckets, sum(corpus.values()) + buckets
    ratio = {b: math.log((trusted[b] + 1) / n1) - math.log((corpus[b] + 1) / n0) for b in range(buckets)}
    out = []
    for i, t in rows:
        b, g = base(t), grams(t, buckets)
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        score = sum(ratio[x] for x in g) / max(2 * b[0] - 1, 1)
        out.append((i, *b, failed, score))
    return out


def compare(got, want, threshold):
    got = sorted(got, key=lambda r: (str(r.doc_id), r.n_words, r.score))
    for r, w in zip(got, sorted(want, key=lambda r: (str(r[0]), r[1], r[-1])), strict=True):
        assert (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == w[:7]
        assert r.score == pytest.approx(w[7], abs=1e-9)
        assert r.kept == (not w[6] and w[7] >= threshold) or abs(w[7] - threshold) < 1e-9


def test_whole_table_equals_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Q.quality(docs, labels).collect()
    compare(got, brute(rows, good), Q.THRESHOLD)
    assert {r.kept for r in got} == {True, False}


def test_edge_cases(spark, docs):
    cyc = "a b c d e f g " * 8
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (4, "x"), (5, cyc), (6, "q\nq\n \n\nq "), (None, "n u l l " * 3),
            (7, "one two three four five one two three four five"), (8, "w" * 50_000), (9, " ".join(map(str, range(30_000)))),
            (10, "a\x0bb\x0cc\rd e\x1cf"), (11, "#*$%&|<> " * 12)]
    df = docs(rows)
    labels = spark.createDataFrame([(5, 1, 0, "x"), (5, 1, 0, "x"), (7, None, 1, "x"), (None, 1, 1, "x"), (99, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    compare(Q.quality(df, labels, buckets=64).collect(), brute(rows, {5}, 64), Q.THRESHOLD)
    assert Q.quality(df.limit(0), labels).count() == 0
    assert Q.quality(df, labels.limit(0), buckets=16).count() == len(rows)


def test_no_python_in_the_plan(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = Q.quality(docs(["a b c"]), labels, buckets=16)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_trusted_document_counts(spark):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert Q.trusted_ids(labels).count() == 20_000


def test_without_trusted_documents_the_base_rules_decide(spark, docs):
    good = " ".join(f"word{i}" for i in range(40))
    df = docs([(1, good), (2, good + " and more"), (3, "too short"), (4, None), (5, "same words here again " * 30)])
    none = spark.createDataFrame([(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.score, r.kept) for r in Q.quality(df, none).collect()}
    assert got == {1: (0.0, True), 2: (0.0, True), 3: (0.0, False), 4: (0.0, False), 5: (0.0, False)}
