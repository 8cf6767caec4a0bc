import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import packing
from quarry.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_cached_ids_are_the_tokenizers():
    rng = random.Random(1)
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.CachedEncoder(PATH, limit=500)
    parts = ["Hello", "don't", "it's", "a1b22", "x__y", "ÄÖß", "e\u0301", "漢字", "<|endoftext|>", "\x0b", "\x0c", "\x1c", "\u00a0",
             "\u3000", "--", "'ll", "İ", "ΟΔΟΣ", "#$%", "thnd,", "\u200b", "é", "\r", "\x85", "I'M", "½", "🙂", "\x00"]
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 30)))
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_keys_walk_unit_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_pieces_rebuild_every_document(spark, docs):
    rng = random.Random(2)
    texts = [None, "", " "] + [" ".join(rng.choices(["alpha", "beta", "Gamma,", "δ"], k=rng.randint(0, 400))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(None, "null key"), (7, texts[7]), (5000, "long " * 3000)]
    pieces = packing.pack(docs(rows), PATH, length=128)
    got = pieces.collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for _, t in rows)
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for k, rs in by_seq.items():  # gapless, full but for the last
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        assert sum(r.length for r in rs) == 128 or k == max(by_seq)
    made = []
    for (doc, total), rs in by_doc.items():
        copies = 2 if doc == 7 else 1
        rs.sort(key=lambda r: (r.start, r.sequence_id))
        if copies == 1:
            assert [r.start for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
            made.append(zlib.crc32(b"".join(bytes(r.ids) for r in rs)))
        assert sum(r.length for r in rs) == total * copies
    assert set(made) <= set(want) and len(made) == len(rows) - 2
    for r in packing.sequences(pieces).collect():
        assert bytes(r.ids) == b"".join(bytes(x.ids) for x in by_seq[r.sequence_id])


def test_neighbours_on_the_curve_and_empty_table(spark, docs):
    kinds = [["tree", "leaf", "root", "wood"], ["ship", "sail", "port", "wave"]]
    rng = random.Random(4)
    df = docs([" ".join(rng.choices(kinds[i % 2], k=100)) for i in range(60)])
    keys = {r.key: r.curve for r in packing.tokenize_on_curve(df, PATH, 2).collect()}
    order = [k % 2 for k in sorted(keys, key=keys.get)]
    assert sum(a != b for a, b in zip(order, order[1:])) < 12  # a random order has about 30 changes
    assert packing.pack(df.limit(0), PATH).count() == 0
