"""Sequence packing along a Hilbert curve over hashed document vectors.

Every document becomes token ids plus an end id, a hashed bag-of-ids vector, a projection to a few
dimensions and the Hilbert key of that point. Documents are ordered by key; the ids, laid end to end
in that order, are cut every `length` ids. Only the last sequence can be short.

Cases: a null or empty text is the end id alone; null keys and repeated rows are packed as rows of
their own (the key only labels the pieces); ties on the curve are ordered by key, then by row; a text
longer than a sequence is cut into as many pieces as it needs; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, per_worker, running_offsets

DIMS, BITS, BUCKETS, SEED = 3, 16, 256, 7
#: White space of the tokenizer is that of str.split, but for these.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_CHUNK = re.compile(r"[^ \n\t\r]+")
#: Pre-tokens of a lower-case Latin-1 chunk: letters together, digits one by one, all else together.
_PART = re.compile("[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


def _byte_letters() -> list[str]:
    """Byte-level spelling: bytes with a visible Latin-1 character are that character, the others
    take the characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class CachedEncoder(dict):
    """Chunk of text between white space -> its ids, little-endian unsigned 32-bit.

    Pre-tokens of the tokenizer never span white space, so chunk by chunk gives the ids of the whole
    text. Chunks of visible Latin-1 characters are split here and go straight to the vocabulary model,
    part by part; all others take the tokenizer's full path. Memory is bounded: chunks and parts are
    forgotten at `limit` each.
    """

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.limit = limit
        self.letters = _byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) >= self.limit:
                self.parts.clear()
            spelled = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            found = self.parts[part] = b"".join([self.packed[t.id] for t in self.tokenize(spelled)])
        return found

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        if chunk.isprintable() and "'" not in chunk and "<|" not in chunk and (chunk.isascii() or max(chunk) <= "ÿ"):
            low = chunk.lower()
            found = self._part(low) if low.isalpha() else b"".join(map(self._part, _PART.findall(low)))
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            found = b"".join([self.packed[i] for i in ids])
        self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        chunks = _CHUNK.findall(text) if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, chunks))


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve index of integer points (n x d, each below 2**bits), by Gray-code unfolding."""
    x = points.astype(np.int64).T.copy()
    d = x.shape[0]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[d - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(documents: list[np.ndarray], dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of documents given as id arrays. The projection and the scale are fixed, so a
    document's key does not depend on the other documents."""
    vectors = np.stack([np.bincount((ids * 2654435761 >> 16) % BUCKETS, minlength=BUCKETS)
                        for ids in documents]).astype(np.float64)
    vectors = np.sqrt(vectors)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    plane = np.random.default_rng(SEED).standard_normal((BUCKETS, dims))
    # Square-root counts are positive: take the common direction out, so that the rest is spread out.
    plane -= plane.mean(axis=0)
    spread = 1.0 / (1.0 + np.exp(-2.0 * (vectors @ plane)))
    return hilbert_keys(np.minimum((spread * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def tokenize_on_curve(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """row_id (unique), `key`, curve, n_tokens and ids (binary), frozen in the shared folder."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker("encoder", tokenizer, lambda: CachedEncoder(tokenizer))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = [encoder.encode(value.as_py() or "") + end for value in part.column(1)]
                keys = curve_keys([np.frombuffer(x, "<u4").astype(np.int64) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(ids))), part.column(0), pa.array(keys),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["row_id", "key", "curve", "n_tokens", "ids"])
                row += len(ids)

    schema = f"row_id long, key {key_type}, curve long, n_tokens long, ids binary"
    return materialize(source.mapInArrow(encode, schema), "tokens")


def pack(docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per piece: `key`, start, length, ids (binary, unsigned 32-bit little-endian),
    doc_tokens, sequence_id and offset.

    Texts are tokenised once and written. Only (curve, key, count) rows take part in the global
    order; the ids move once, to meet their document's position.
    """
    tokens = tokenize_on_curve(docs, tokenizer, end_id, key, text)
    places = running_offsets(tokens.select("row_id", "key", "curve", "n_tokens"),
                             ["curve", "key", "row_id"], "n_tokens", "place").select("row_id", "place")
    placed = tokens.select("row_id", "key", "n_tokens", "ids").join(places, "row_id").select(
        "key", "n_tokens", "ids", "place")
    last = F.col("place") + F.col("n_tokens")
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("place") / length), F.floor((last - 1) / length))))
    low, high = F.col("sequence_id") * length, (F.col("sequence_id") + 1) * length
    begin, end = F.greatest("place", low), F.least(last, high)
    return cut.select(
        F.col("key").alias(key), (begin - F.col("place")).alias("start"), (end - begin).alias("length"),
        F.substring("ids", (4 * (begin - F.col("place")) + 1).cast("int"), (4 * (end - begin)).cast("int")).alias("ids"),
        F.col("n_tokens").alias("doc_tokens"), "sequence_id", (begin - low).alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id and its ids (binary), from the rows of `pack`; a group holds one sequence only."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
