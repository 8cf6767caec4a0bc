"""The pipeline against a chain of the operators' brute-force versions."""

import zlib

import numpy as np
import pytest
import test_decontam
import test_jaccard_join
import test_line_dedup
import test_quality
from tokenizers import Tokenizer

import corpus_pipeline as P
from quarry.llm import decontam, quality
from quarry.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def brute(rows, good, items):
    """Documents before packing: (doc_id, text)."""
    scored = test_quality.brute(rows, good)
    docs = [r for r, s in zip(rows, scored, strict=True) if not s[6] and s[7] >= quality.THRESHOLD]
    texts = test_line_dedup.brute(docs, 50)
    docs = [(i, t) for (i, old), t in zip(docs, texts, strict=True) if t == old or t.strip()]
    least = {}
    for i, c, _, _ in test_jaccard_join.brute(docs):
        least.setdefault(c, i)
    docs = [(i, t) for i, t in docs if str(i) in least]
    holds = lambda t: any(test_decontam.sellers(x, t) <= int(len(x) * decontam.MAX_ERROR) for x in items if x in t or x[:20] in t or x[-20:] in t)
    return [(i, t) for i, t in docs if not holds(decontam.normalize(t))]


@pytest.fixture(scope="module")
def stages(spark):
    """The result of each stage on the smallest tables, with columns that clash with inner names."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS kept", "'x' AS path", "2 AS n", "3 AS id")
    out = [docs]
    for _, stage in P.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_columns_stay(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == stages[0].columns
        assert after.schema.simpleString() == before.schema.simpleString()
        assert 0 < after.count() <= before.count()


def test_pipeline_equals_brute_force(spark, stages):
    rows = [(r.doc_id, r.text) for r in stages[0].select("doc_id", "text").orderBy("doc_id").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    items = [decontam.normalize(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [x for x in items if len(x) >= decontam.MIN_CHARS]
    want = dict(brute(rows, good, items))
    got = {r.doc_id: r.text for r in stages[-2].collect()}
    assert got == want
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = {}
    for r in stages[-1].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == want.keys()
    for i, ps in pieces.items():
        ps.sort(key=lambda p: p.start)
        ids = np.array(tokenizer.encode(want[i], add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert b"".join(bytes(p.ids) for p in ps) == ids
        assert all(p.ids_crc32 == zlib.crc32(bytes(p.ids)) for p in ps)


def test_run_gives_the_last_stage(spark, stages):
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(map(tuple, P.run(spark, SF).select(*key).collect())) == sorted(map(tuple, stages[-1].select(*key).collect()))


def test_odd_rows_pass_every_stage(spark, docs):
    words = " ".join(f"w{i}" for i in range(60))
    rows = docs([(1, None), (2, ""), (None, words), (3, words), (3, words), (4, words + " end"), (5, "v " * 50_000), (6, "x\n\ny")])
    for _, stage in P.STAGES:
        assert stage(spark, rows, SF).count() >= 0
        assert stage(spark, rows.limit(0), SF).count() == 0
    kept = P.near_duplicates(spark, rows, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "5", "6"]
    left = {r.doc_id: r.n_chars for r in P.line_deduplication(spark, docs([(1, words), (2, words + "\nmore")]), SF).collect()}
    assert left == {1: None, 2: 4}
