"""Byte-level BPE against the tokenizer library, on texts of every kind and in several chunks."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from quarry.llm import byte_bpe
from quarry.llm.common import table
from quarry.llm.queries import op11_byte_bpe, tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def words(texts):
    out = []
    for _, block in byte_bpe.blocks_of(texts):
        found, number, stops = byte_bpe.distinct_words(block)
        text = []
        for n, stop in zip(number.tolist(), stops.tolist()):
            if stop:
                out.append(text)
                text = []
            else:
                text.append(found[n].decode())
    return out


def test_pretokens_equal_the_pattern():
    import public_tokenizers
    import regex

    rng = random.Random(7)
    letters = " \n\t'strvelmd aZ09.,-é中　\x85 \x1c😀'' \r"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(5000)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert words(texts) == [pattern.findall(t) for t in texts]


@pytest.mark.parametrize("piece", ["a" * 3000, "ab" * 800, "é" * 900, "thereforehello" * 9, "zq", " the", "\n\n\n"])
def test_pieces_of_any_length(ranks, library, piece):
    assert byte_bpe.merge_bytes(piece.encode(), ranks) == library._encode_single_piece(piece)


def test_texts_in_several_chunks(spark, docs, ranks, library):
    rng = random.Random(3)
    some = ["", None, " ", "it's they'll 'S don't 'd", "x" * 5000, "日本語 テキスト\n\n 12345", "same text", "same text"]
    some += [" ".join(rng.choice(["alpha", "beta", "naïve", "42", "--", "'re"]) for _ in range(50)) for _ in range(60)]
    rows = list(enumerate(some)) + [(3, some[3]), (None, "no id"), (None, "no id"), (3, "other text of one id")]
    df = docs(rows)
    df = df.withColumn("ids", df.lang).withColumn("chunk", df.lang).withColumn("copies", df.lang)
    coded = byte_bpe.encode(df, ranks, chunk_bytes=700, decoded=True)
    again = byte_bpe.decode(coded.withColumnRenamed("decoded", "before"), ranks)
    assert again.filter("decoded <> before").count() == 0
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in coded.collect()), key=str)
    want = []
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert got == sorted(want, key=str)


def test_words_meet_in_one_exchange(spark, docs, ranks):
    """All chunks' rows of a word meet in one exchange, whose sorted rows are encoded."""
    plan = byte_bpe.encode(docs(["a b", "b c"]), ranks)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" in plan


def test_empty_table_and_foreign_ids(spark, docs, ranks):
    coded = byte_bpe.encode(docs(["x"]).limit(0), ranks)
    assert coded.count() == 0 and coded.columns == ["doc_id", "n_tokens", "ids"]
    bad = spark.createDataFrame([(1, bytearray(np.array([60000], "<u4").tobytes()))], "k long, ids binary")
    none = spark.createDataFrame([(1, None), (2, bytearray())], "k long, ids binary")
    assert [r.decoded for r in byte_bpe.decode(none, ranks).orderBy("k").collect()] == [None, b""]
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(bad, ranks).collect()


def test_query_over_whole_documents(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op11_byte_bpe(spark, SMALL).collect()}
    want = {}
    for r in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    assert got == want
