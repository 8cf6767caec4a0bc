import random

from quarry.llm import decontam as D


def sellers(pattern, text):
    """Lowest edit distance of the pattern to any substring, by the full table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != p)))
        row = new
        best = min(best, row[-1])
    return best


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "q" + text[i:], text[:i] + "q" + text[i + 1:]])
    return text


def corpus(rng, n_items=6, n_docs=60):
    word = lambda: "".join(rng.choices("abcdef", k=rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(10, 16))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        text = prose(rng.randint(0, 60))
        if i % 2:
            text += " " + edited(rng, rng.choice(items)[1], rng.randint(0, 8)) + "\n" + prose(5)
        docs.append((i, text))
    return items, docs


def test_matches_equal_brute_force(spark, docs):
    rng = random.Random(8)
    items, rows = corpus(rng)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(docs(rows), bench, max_error=0.08).collect()
    want = {}
    for d, text in rows:
        for i, item in items:
            found = sellers(D.normalize(item), D.normalize(text))
            if found <= int(len(D.normalize(item)) * 0.08):
                want[d, i] = found
    assert {(r.doc_id, r.item_id): r.distance for r in got} == want and len(want) > 10
    text, item = dict(rows), dict(items)
    for r in got:
        piece = D.normalize(text[r.doc_id])[r.start:r.end]
        assert sellers(piece, "") == len(piece)
        assert abs(len(piece) - len(item[r.item_id])) <= r.distance
        assert sellers(D.normalize(item[r.item_id]), piece) == r.distance


def test_blocks_and_removal_agree(spark, docs):
    items, rows = corpus(random.Random(9))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows)
    one = sorted(D.find_contamination(df, bench).collect())
    assert one == sorted(D.find_contamination(df, bench, block_chars=50).collect())
    left = {r.doc_id for r in D.decontaminate(df, bench).collect()}
    assert left == {i for i, _ in rows} - {r.doc_id for r in one}


def test_edge_cases(spark, docs):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    bench = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, ""), (5, "short"), (None, "n" * 50)],
                                  "item_id long, text string")
    long = "x " * 200_000 + item.replace(" ", "\n\t ") + " y" * 1000
    df = docs([(1, None), (2, ""), (3, item), (3, item), (None, "n" * 60), (4, long), (5, "short"), (6, item[:30])])
    got = D.find_contamination(df, bench).collect()
    assert sorted(str((r.doc_id, r.item_id, r.distance)) for r in got) == sorted(
        str(x) for x in [(3, 1, 0), (3, 2, 0)] * 2 + [(None, None, 0), (4, 1, 0), (4, 2, 0)])
    assert sorted(str(r.doc_id) for r in D.decontaminate(df, bench).collect()) == ["1", "2", "5", "6"]
    assert D.find_contamination(df.limit(0), bench).count() == 0
    assert D.find_contamination(df, bench.limit(0)).count() == 0
    assert D.decontaminate(df, bench.limit(0)).count() == 8
