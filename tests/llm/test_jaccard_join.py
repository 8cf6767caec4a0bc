import random
import re

import pytest

from quarry.llm import jaccard_join as J
from quarry.llm.common import WORD


SKETCHES = ["sketch", "splits"]


def shingles(text):
    w = re.findall(WORD, text or "")
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """(class, links, different texts linked) per row; equal (id, text) rows are one document's rows."""
    sets = [shingles(t) for _, t in rows]
    n, near = len(rows), []
    for i in range(n):
        near.append({j for j in range(n) if i != j and sets[i] and sets[j]
                     and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])})
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(n)]
        if new == label:
            break
        label = new
    classes = {}
    for i, x in enumerate(label):
        classes.setdefault(x, []).append(rows[i][0])
    least = {x: min((i for i in ids if i is not None), default=None) for x, ids in classes.items()}
    return sorted((str(rows[i][0]), str(least[label[i]]), len(near[i]), len({sets[j] for j in near[i]} - {sets[i]})) for i in range(n))


def corpus(rng, groups=12, size=9):
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    shared = " ".join(word() for _ in range(30))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(40, 120))]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own) + (" " + shared if g % 3 == 0 else ""))
            if rng.random() < 0.3:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(df):
    return sorted((str(r.id), str(r.class_id), r.n_links, r.n_link_texts) for r in df.collect())


def test_equals_brute_force(spark, docs):
    rows = corpus(random.Random(2))
    assert result(J.near_duplicates(docs(rows))) == brute(rows)


def test_splits_and_blocks_lose_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(J, "BUCKET", 4)
    monkeypatch.setattr(J, "DEPTH", 2)
    monkeypatch.setattr(J, "BLOCK_MEMBERS", 5)
    rows = corpus(random.Random(4), groups=4, size=40)
    assert result(J.near_duplicates(docs(rows))) == brute(rows)


def test_links_count_once_where_other_blocks_are_empty(spark, docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 30)
    texts = [" ".join(f"{g}w{i}" for i in range(50)) for g in range(40)]
    rows = list(enumerate(x for t in texts for x in (t, t + " x")))
    assert result(J.near_duplicates(docs(rows))) == brute(rows)


def test_edge_cases(spark, docs):
    long = " ".join(map(str, range(40_000)))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "b a"), (7, long), (8, long + " x"), (None, long),
            (9, "p q r s t u v"), (None, "solo text of more than five words"), (10, "p q r s t u v"), (11, "a b"), (11, "a b")]
    got = result(J.near_duplicates(docs(rows)))
    assert got == brute(rows)
    assert J.near_duplicates(docs(rows).limit(0)).count() == 0


def test_connect_finds_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    edges = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs if a != b], "a binary, b binary")
    got = {r.member[0]: r.label[0] for r in J.connect(edges).collect()}
    label = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert all(got[x] == label[x] for x in got)
    assert all(got[x] == 100 for x in range(100, 141))


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_sketch_misses_are_rare(similarity):
    rng = random.Random(0)
    shingler = J.Shingler(5)
    near = 0
    for _ in range(100):
        n = 200
        only = round(n * (1 - similarity) / (1 + similarity))
        common = [rng.getrandbits(64) for _ in range(n - only)]
        a, b = (J.np.unique(J.np.array(common + [rng.getrandbits(64) for _ in range(only)], J.np.uint64)) for _ in range(2))
        x, y = shingler.sketch(a), shingler.sketch(b)
        near += (x[:J.RUNS] == y[:J.RUNS]).any() and (x == y).mean() >= J.NEAR
    assert near >= 99


def hot_template(rng, groups=500):
    """Texts around one template, far from each other, each with one partner close to the threshold."""
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    template, rows = [word() for _ in range(150)], []
    for _ in range(groups):
        own = list(template)
        for i in rng.sample(range(150), 14):
            own[i] = word()
        rows.append(" ".join(own))
        other = list(own)
        for i in rng.sample(range(150), 3):
            other[i] = word()
        rows.append(" ".join(other))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_hot_template_recall(spark, docs, monkeypatch):
    monkeypatch.setattr(J, "BUCKET", 6)
    rows = hot_template(random.Random(3))
    edges = J.candidate_edges(J.sketches(docs(rows)).select("id", "member", "firsts", *SKETCHES)).collect()
    sets = [shingles(t) for _, t in rows]
    names = {r.id: bytes(r.member) for r in J.sketches(docs(rows)).select("id", "member").collect()}
    label = {x: x for x in names.values()}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for e in edges:
        label[root(bytes(e.a))] = root(bytes(e.b))
    near = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    # A candidate component is exact later on: a pair is found if it lies in one.
    missed = sum(root(names[i]) != root(names[j]) for i, j in near)
    assert len(near) > 300 and missed <= (1 - J.RECALL) * len(near) + 1


@pytest.mark.parametrize("strangers", [0, 2])
def test_near_copies_of_one_leader_do_not_split_on(spark, docs, monkeypatch, strangers):
    """A large bucket whose members are linked to its leader, but for a few strangers, is done."""
    monkeypatch.setattr(J, "BUCKET", 8)
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    template, texts = [word() for _ in range(150)], []
    for _ in range(60):
        own = list(template)
        own[rng.randrange(150)] = own[rng.randrange(150)] = word()
        texts.append(" ".join(own))
    for _ in range(strangers):  # a third of the template, and another of their kind
        own = template[:60] + [word() for _ in range(90)]
        texts += [" ".join(own), " ".join(own[:-1])]
    members = J.sketches(docs(texts)).select("id", "member", "firsts", *SKETCHES)
    asked = []

    def splits(need):
        asked.append(need.count())
        return members.select("member", "splits").join(need, "member", "left_semi")

    edges = J.candidate_edges(members.drop("splits"), splits=splits)
    label = {r.member: r.label for r in J.connect(edges).collect()}
    classes = {r.id: label[r.member] for r in members.select("id", "member").collect()}
    assert not asked
    assert len({classes[i] for i in range(60)}) == 1
    assert all(classes[60 + 2 * k] == classes[61 + 2 * k] for k in range(strangers))


def test_runs_meet_the_recall_with_all_splits():
    rng = random.Random(5)
    common, found = 160, 0
    shingler = J.Shingler(5, orders=J.RUNS + J.SKETCH + J.RUNS * J.DEPTH * J.WAYS)
    for _ in range(2000):
        a, b = (J.np.unique(J.np.array(c, J.np.uint64)) for c in (lambda s: (s + [rng.getrandbits(64) for _ in range(20)],
                s + [rng.getrandbits(64) for _ in range(20)]))([rng.getrandbits(64) for _ in range(common)]))
        same = shingler.sketch(a) == shingler.sketch(b)
        splits = same[J.RUNS + J.SKETCH:].reshape(J.RUNS, J.DEPTH, J.WAYS)
        for run in range(J.RUNS):
            nodes = int(same[run])
            for depth in range(J.DEPTH):
                picks = [(rng.randrange(J.WAYS), rng.random() < 0.25) for _ in range(nodes)]
                nodes = sum(int(splits[run, depth, k]) + (two and int(splits[run, depth, (k + 1) % J.WAYS])) for k, two in picks)
            if nodes:
                found += 1
                break
    assert found >= 2000 * (J.RECALL - 0.0015)
    assert J.runs_needed(0.99, 0.8, J.DEPTH) < J.runs_needed(0.999, 0.8, J.DEPTH)
    with pytest.raises(ValueError):
        J.runs_needed(1.0, 0.8, J.DEPTH)


def test_columns_of_any_name_come_through_the_stage(spark):
    names = ["__hash", "__id", "__th", "__no", "row", "key", "hash", "id", "th", "no"]
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate([text, text + " w40", "other words", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = J.keep_one_per_class(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {0, 2, 3} and all(got[i][n] == f"{n}{i}" for i in got for n in names)
