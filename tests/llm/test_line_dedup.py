import random
import re

from quarry.llm import line_dedup as L


def words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]


def brute(rows, min_words):
    """Lines covered by any run of min_words words that starts at an earlier position too. Runs that
    stay long enough without their first and without their last line are unions of shorter ones."""
    seq = [(d, no, line.strip(" \t\x0b\x0c\r")) for d, (_, text) in enumerate(rows)
           for no, line in enumerate((text or "").split("\n")) if words(line)]
    size, first, gone = [len(words(x[2])) for x in seq], {}, set()
    for a in range(len(seq)):
        for b in range(a, len(seq)):
            if seq[b][0] != seq[a][0]:
                break
            total = sum(size[a:b + 1])
            if total - max(size[a], size[b]) >= min_words:
                break
            run = tuple(x[2] for x in seq[a:b + 1])
            if total >= min_words:
                if first.setdefault(run, a) < a:
                    gone.update((x[0], x[1]) for x in seq[a:b + 1])
    return [None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (d, no) not in gone)
            for d, (_, t) in enumerate(rows)]


def random_rows(rng, n):
    lines = [" ".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(6)]
    block = [rng.choice(lines) for _ in range(5)]
    rows = []
    for i in range(n):
        own = [rng.choice(lines + ["", " \t", f"own {i}"]) for _ in range(rng.randint(0, 7))]
        if rng.random() < 0.4:
            own[1:1] = block[rng.randint(0, 2):]
        rows.append((i, "\n".join(own)))
    return rows


def test_equals_brute_force(spark, docs):
    rng = random.Random(6)
    for min_words in (1, 5, 9):
        rows = random_rows(rng, 25)
        got = {r.doc_id: r.text for r in L.dedup_lines(docs(rows), min_words).collect()}
        assert [got[i] for i, _ in rows] == brute(rows, min_words), min_words


def test_suffix_array_equals_sorting(spark, docs):
    rows = random_rows(random.Random(3), 30)
    df = docs(rows)
    ids = {(r.id, x.no): (x.a, x.b) for r in L.line_sequences(df).collect() for x in r.lines}
    at = {}
    for r in sorted(L.line_sequences(df).collect(), key=lambda r: r.start):
        for k, x in enumerate(r.lines):
            at[r.start + k] = [ids[r.id, y.no] for y in r.lines[k:]]
    for depth in (1, 2, 4):
        prefix = {p: tuple(s[:depth]) for p, s in at.items() if len(s) >= depth}
        twice = [p for p in prefix if sum(q == prefix[p] for q in prefix.values()) > 1]
        order = sorted(prefix[p] for p in twice)
        want = {p: order.index(prefix[p]) for p in twice}
        assert {r.pos: r["rank"] for r in L.suffix_array(df, depth).collect()} == want


def test_edge_cases(spark, docs):
    run = "one two three\nfour five six"
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, run), (4, run), (4, run), (5, f"x\n\n{run}\r\n\nend"), (6, "w " * 30_000),
            (7, "w " * 30_000), (8, f"  {run}  "), (9, "one two three"), (10, "\n".join(["a"] * 12))]
    df = docs(rows)
    got = L.dedup_lines(df, 6)
    assert set(df.columns) < set(got.columns)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.text, r["__removed"], r["__left"]))
    assert by == {1: [(None, 0, False)], 2: [("", 0, False)], 3: [("\n \n", 0, False)], None: [(run, 0, True)],
                  4: [("", 2, False)] * 2, 5: [("x\n\n\nend", 2, True)], 6: [("w " * 30_000, 0, True)], 7: [("", 1, False)],
                  8: [("", 2, False)], 9: [("one two three", 0, True)], 10: [("a", 11, True)]}
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = L.dedup_lines(docs(["a\nb", "a\nb"]), 2)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_columns_of_any_name_come_through(spark):
    run = "\n".join(f"line {i} " + "word " * 20 for i in range(4))
    names = ["__hash", "__id", "__th", "__gone", "__removed", "__left", "row", "key", "hash", "id", "th", "gone", "removed", "left"]
    rows = [(i, f"{t}", 7, *[f"{n}{i}" for n in names]) for i, t in enumerate([run, f"own {run}", f"mine\n{run}", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    out = L.drop_repeated_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "mine" and got[2].n_chars == 4 and got[0].n_chars == 7
    assert all(got[i][n] == f"{n}{i}" for i in got for n in names)
    found = L.dedup_lines(df)
    assert found.columns == [c for c in df.columns if c not in ("__removed", "__left")] + ["__removed", "__left"]
    assert {r.doc_id: r["__removed"] for r in found.collect()}[2] == 4
