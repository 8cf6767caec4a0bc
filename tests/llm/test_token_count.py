import random

import pytest

from quarry.llm import token_count
from quarry.llm.queries import tokenizer_path


def brute(scores, word, byte_score):
    """Best (score, -tokens) over all segmentations, by recursion over the last piece."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * byte_score, best[end - 1][1] - n)]
        options += [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_counts_equal_brute_force(spark, docs):
    rng = random.Random(5)
    scores = token_count.unigram_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    byte_score = min(scores.values()) - token_count.BYTE_PENALTY
    words = ["".join(rng.choices("thearingoüß漢", k=rng.randint(1, 12))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(30)]
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs(texts), scores).collect()}
    assert got == {i: sum(brute(scores, "▁" + w, byte_score) for w in t.split()) for i, t in enumerate(texts)}


def test_small_memory_gives_the_same_counts():
    scores = {"▁": -1.0, "a": -2.0, "ab": -2.5, "b": -2.0, "▁ab": -2.0}
    big, small = token_count.PrefixTrie(scores), token_count.PrefixTrie(scores, max_nodes=3, max_words=2)
    for words in (["ab", "aab", "ab"], ["b", "ba", "bab"], ["ab"]):
        assert big.count_words(words) == small.count_words(words)


def test_edge_cases(spark, docs):
    scores = {"▁": -1.0, "a": -2.0}
    df = docs([(1, None), (2, ""), (3, " \t\n"), (4, "a a"), (4, "a a"), (None, "z"), (5, "a " * 100_000)])
    got = sorted((tuple(r) for r in token_count.count_tokens(df, scores).collect()), key=str)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 4), (4, 2, 4), (None, 1, 2),
                          (5, 100_000, 200_000)], key=str)
    assert token_count.count_tokens(df.limit(0), scores).count() == 0
    with pytest.raises(ValueError):
        token_count.count_tokens(df, scores, max_vocabulary=1)
