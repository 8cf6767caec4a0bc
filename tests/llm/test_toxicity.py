import itertools
import zlib

import numpy as np
import pytest

from quarry.llm import toxicity as X
from quarry.llm.queries import op5_toxicity


def brute_kernel(s, t, order):
    """All pairs of equal subsequences, each GAP to the power of both spans."""
    total = 0.0
    for a in itertools.combinations(range(len(s)), order):
        for b in itertools.combinations(range(len(t)), order):
            if [s[i] for i in a] == [t[j] for j in b]:
                total += X.GAP ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_equals_its_definition():
    words, marks = ["^idiot", "^idxiot", "^dit", "^aa", "^zzz", "^toidi"], ["^idiot", "^aab", "^xyz"]
    got = X.SubsequenceKernel(marks)(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            parts = [brute_kernel(w, m, p) / np.sqrt(brute_kernel(w, w, p) * brute_kernel(m, m, p)) for p in (2, 3)]
            assert got[i, j] == pytest.approx(np.mean(parts), abs=1e-5)


def test_folded_margins_equal_the_kernel_machine():
    words = ["^idiot", "^a", "^", "^worthless", "^zzzzzzzz", "^toidi-xyz", "^aab"]
    model = X.ToxicModel(["^idiot", "^aab", "^xyz"], np.array([1.5, -0.5, 0.25]), -0.3)
    want = X.SubsequenceKernel(model.landmarks)(words) @ model.weights + model.bias
    assert X.MarginScorer(model).word_margins(words) == pytest.approx(want, abs=1e-5)


def test_machine_separates():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(1, .3, (40, 3)), rng.normal(-1, .3, (200, 3))])
    y = np.array([1.0] * 40 + [-1.0] * 200)
    w = X.fit_machine(x, y, np.ones(240))
    assert ((np.hstack([x, np.ones((240, 1))]) @ w > 0) == (y > 0)).all()


def test_held_out_accuracy_and_disguise(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op5_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[i].score, y) for i, y in labels.items() if got[i].held_out]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85 and np.mean([p >= 0.5 for p in pos]) > 0.8 and np.mean([n >= 0.5 for n in neg]) < 0.3


def test_disguised_words_score_near_the_plain_one():
    model = X.ToxicModel(["^idiot"], np.array([1.0]), 0.0)
    plain, inserted, gapped, other = X.MarginScorer(model).token_margins(["idiot", "idxiot", "i.d.i.o.t", "kindness"])
    assert plain > inserted > gapped > 0 and other < inserted / 2


def test_edge_cases(spark, docs):
    rows = [(i, f"word{i} fine text") for i in range(40)] + [(100 + i, f"you{i} awfulscum here{i}") for i in range(40)]
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 1, 1) for i in range(40)]
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = X.fit_toxicity(docs(rows), lab)
    odd = docs([(1, None), (2, ""), (3, "  \n"), (4, "..."), (5, "awfulscum" * 20_000), (6, "a " * 100_000), (None, "awfulscum"), (7, "x"), (7, "x")])
    got = X.score_toxicity(odd, model).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3] < 0.5 < by[None]
    assert X.score_toxicity(odd.limit(0), model).count() == 0
    base = X.fit_toxicity(docs(rows), lab.limit(0))
    assert len({r.score for r in X.score_toxicity(odd, base).collect()}) == 1
