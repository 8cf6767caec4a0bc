"""Token counts under a unigram vocabulary, by dynamic programming on a trie of pre-tokens.

A pre-token is a word (see `common.WORD`) with a leading word mark. Its tokens are the segmentation
into vocabulary pieces with the highest sum of log-probabilities; equal sums go to fewer tokens. A
character that no piece covers falls back to its UTF-8 bytes, one token each.

Cases: null, empty and blank texts have no pre-tokens and count 0; repeated rows are counted one by
one; an empty table gives an empty result; only the columns named are read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, per_worker

MARK = "▁"
#: Log-probability charged for each byte of a character outside the vocabulary, below any piece.
BYTE_PENALTY = 10.0


def unigram_vocabulary(path: str) -> dict[str, float]:
    """Piece -> log-probability. The file ranks its pieces; ranks are read as a Zipf distribution."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    norm = math.log(sum(1.0 / (r + 1) for r in range(len(pieces))))
    scores: dict[str, float] = {}
    for rank, piece in enumerate(pieces):
        scores.setdefault(piece, -math.log(rank + 1) - norm)
    return scores


class PrefixTrie:
    """Trie nodes keep the forward score and token count of their prefix, so that words that share a
    prefix share its dynamic programming; the count at a word's last node is its token count."""

    def __init__(self, scores: dict[str, float], max_nodes: int = 200_000, max_words: int = 400_000):
        self.scores, self.max_nodes, self.max_words = scores, max_nodes, max_words
        #: Ends of pieces: no piece ends in a string that is not among them.
        self.ends = {piece[i:] for piece in scores for i in range(len(piece))}
        self.byte_score = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.counts = _Counts(self)
        self._clear()

    def _clear(self) -> None:
        self.root: list = [0.0, 0, {}]
        self.nodes = 1

    def insert(self, word: str) -> int:
        """Walk `word`, adding the nodes that are missing; its token count."""
        if self.nodes > self.max_nodes:  # bounded memory: later words compute their prefixes again
            self._clear()
        scores, ends = self.scores, self.ends
        node, best, count = self.root, [0.0], [0]
        for end in range(1, len(word) + 1):
            child = node[2].get(word[end - 1])
            if child is None:
                n_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
                top = best[end - 1] + n_bytes * self.byte_score
                fewest = count[end - 1] + n_bytes
                for start in range(end - 1, -1, -1):
                    part = word[start:end]
                    piece = scores.get(part)
                    if piece is None:
                        if part not in ends:
                            break
                    else:
                        score, tokens = best[start] + piece, count[start] + 1
                        if score > top or (score == top and tokens < fewest):
                            top, fewest = score, tokens
                child = node[2][word[end - 1]] = [top, fewest, {}]
                self.nodes += 1
            node = child
            best.append(node[0])
            count.append(node[1])
        return node[1]

    def count_words(self, words: list[str]) -> int:
        return sum(map(self.counts.__getitem__, words))


class _Counts(dict):
    """Word -> its terminal count; remembers at most the trie's `max_words` words."""

    def __init__(self, trie: PrefixTrie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str) -> int:
        if len(self) >= self.trie.max_words:
            self.clear()
        found = self[word] = self.trie.insert(MARK + word)
        return found


def count_tokens(df: DataFrame, scores: dict[str, float], key: str = "doc_id", text: str = "text",
                 max_vocabulary: int = 1_000_000) -> DataFrame:
    """`key`, n_words (pre-tokens) and n_tokens of every row's whole text.

    The vocabulary is broadcast (at most `max_vocabulary` pieces, else ValueError: it is a fixed file,
    not data). Each task inserts the distinct pre-tokens it meets into its own trie, whose nodes and
    remembered words are bounded, so neither a shuffle nor a corpus-wide word list is needed.
    """
    if len(scores) > max_vocabulary:
        raise ValueError(f"vocabulary of {len(scores)} pieces exceeds {max_vocabulary}")
    shared, version = df.sparkSession.sparkContext.broadcast(scores), uuid.uuid4().hex
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = source.schema["key"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = per_worker("trie", version, lambda: PrefixTrie(shared.value))
        words_of = re.compile(WORD).findall
        for batch in batches:
            words, tokens = [], []
            for value in batch.column(1):
                found = words_of(value.as_py() or "")
                words.append(len(found))
                tokens.append(trie.count_words(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["key", "n_words", "n_tokens"])

    return (source.mapInArrow(count, f"key {key_type}, n_words long, n_tokens long")
            .withColumnRenamed("key", key))
