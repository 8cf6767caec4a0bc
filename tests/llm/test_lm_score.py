import math
import random

import numpy as np
import pytest

from quarry.llm import lm_score as M


def brute(net, ids):
    """Every word's conditional log-probability, one at a time in plain Python."""
    total, pad = 0.0, [0] * net.side + list(ids) + [0] * net.side
    for i, word in enumerate(ids):
        around = pad[i:i + net.side] + pad[i + net.side + 1:i + 2 * net.side + 1]
        hidden = [math.tanh(sum(float(net.sides[k][w][h]) for k, w in enumerate(around)) + float(net.inner[h])) for h in range(len(net.inner))]
        z = [sum(hidden[h] * float(net.out[h][c]) for h in range(len(hidden))) + float(net.out_bias[c]) for c in range(len(net.out_bias))]
        c = net.class_of[word]
        total += z[c] - math.log(sum(map(math.exp, z))) + net.share[word]
    return total


def corpus(rng, n):
    frames = [["the", "{}", "eats", "the", "{}", "today"], ["a", "{}", "sees", "some", "{}", "now"]]
    nouns = [["cat", "dog", "bird"], ["car", "bus", "train"]]
    return [" ".join(w.format(rng.choice(nouns[k])) for _ in range(12) for w in frames[k]) for k in (rng.randrange(2) for _ in range(n))]


def test_scores_equal_brute_force_and_probabilities_sum_to_one(spark, docs):
    texts = corpus(random.Random(1), 12) + ["", "one"]
    net = M.fit_network(docs(texts), buckets=64)
    of = M.Buckets(64).of
    got = {r.doc_id: r for r in M.score_documents(docs(texts), net).collect()}
    for i, t in enumerate(texts):
        assert got[i].log_likelihood == pytest.approx(brute(net, of(t)), rel=1e-4)
        assert got[i].n_words == len(t.split())
    near = net.windows(of(texts[0]))[3:4]
    _, z = net.forward(near)
    assert (np.exp(z[0])[net.class_of] * np.exp(net.share)).sum() == pytest.approx(1.0, abs=1e-4)


def test_training_helps_and_order_matters(spark, docs):
    rng = random.Random(2)
    texts, held = corpus(rng, 900), corpus(rng, 30)
    start = M.WindowNetwork.start(M.corpus_counts(docs(texts), 256))
    net = M.train_network(docs(texts).repartition(3), start)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in held]
    mean = lambda n, ts: np.mean([r.mean_log_likelihood for r in M.score_documents(docs(ts), n).collect()])
    assert mean(net, held) > mean(start, held) + 0.3
    assert mean(net, held) > mean(net, mixed) + 0.3


def test_network_does_not_depend_on_task_order(spark, docs):
    df = docs(corpus(random.Random(3), 40)).repartition(4)
    a, b = M.fit_network(df, buckets=64), M.fit_network(df, buckets=64)
    assert (a.weights() == b.weights()).all()


def test_counts_cover_every_row(spark, docs):
    texts = ["a b a", "b", None, "a b a"]
    counts = M.corpus_counts(docs(texts), 64)
    of = M.Buckets(64).of
    assert counts.sum() == 7 and counts[of("a")[0]] >= 4


def test_edge_cases(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x"), (5, "long " * 70_000), (None, "a b"), (6, "a b"), (6, "a b")]
    net = M.fit_network(docs(rows), buckets=32)
    got = {}
    for r in M.score_documents(docs(rows), net).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.log_likelihood, r.mean_log_likelihood))
    assert got[1] == got[2] == got[3] == [(0, 0.0, None)]
    assert got[5][0][0] == 70_000 and len(got[6]) == 2 and got[6][0] == got[6][1] == got[None][0]
    empty = docs(rows).limit(0)
    assert M.score_documents(empty, M.fit_network(empty, buckets=32)).count() == 0
