"""Document scores by masked pseudo-likelihood under a bidirectional window network.

Words fall into hashed buckets. The network sees the buckets of the `SIDE` words on either side of a
masked word, adds one learned vector per neighbour and position, and predicts the masked word's class
through a hidden layer; classes are groups of buckets of about equal corpus frequency, and within its
class a bucket has its corpus share. A document's score is the sum over all its words of
log p(class | both sides) + log p(bucket | class).

Corpus counts and training cover every word of every document: each task trains the same starting
network on its documents in numpy, and the tasks' networks are averaged by words seen. Averages are
sums of fixed-point integers, so their order does not matter.

Cases: null, empty and blank texts have no words, log-likelihood 0 and a null mean; a document's ends
are a bucket of their own; repeated rows are scored one by one and count as often as they occur; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, materialize, per_worker

BUCKETS, CLASSES, HIDDEN, SIDE = 4096, 32, 16, 2
BATCH, RATE = 512, 0.3
#: Fixed-point scale of averaged weights, and words trained or scored at once.
SCALE, SLICE = 1 << 20, 1 << 15


class Buckets(dict):
    """Word -> bucket (0 is the document's end); remembers at most `limit` words."""

    def __init__(self, buckets: int, limit: int = 400_000):
        super().__init__()
        self.buckets, self.limit, self.words = buckets, limit, re.compile(WORD).findall

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (self.buckets - 1)
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = self.words(text or "")
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass
class WindowNetwork:
    """`sides`: 2 SIDE x buckets x hidden; `inner`: hidden bias; `out`, `out_bias`: to the classes.
    `class_of` and `share` (log p(bucket | class)) come from corpus counts."""

    sides: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    class_of: np.ndarray
    share: np.ndarray

    @staticmethod
    def start(counts: np.ndarray, classes: int = CLASSES, hidden: int = HIDDEN, side: int = SIDE, seed: int = 1) -> "WindowNetwork":
        rng = np.random.default_rng(seed)
        smooth = counts + 1.0
        order = np.argsort(-smooth, kind="stable")
        mass = np.cumsum(smooth[order]) - smooth[order] / 2
        class_of = np.empty(len(counts), np.int64)
        class_of[order] = np.minimum((mass / smooth.sum() * classes).astype(np.int64), classes - 1)
        class_of = np.unique(class_of, return_inverse=True)[1]  # a very frequent bucket leaves classes empty
        totals = np.bincount(class_of, weights=smooth)
        return WindowNetwork(
            (rng.standard_normal((2 * side, len(counts), hidden)) * 0.1).astype(np.float32), np.zeros(hidden, np.float32),
            (rng.standard_normal((hidden, len(totals))) * 0.1).astype(np.float32),
            np.log(totals / totals.sum()).astype(np.float32), class_of, np.log(smooth / totals[class_of]))

    @property
    def side(self) -> int:
        return len(self.sides) // 2

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """n x 2 side neighbours of each position; beyond the ends bucket 0."""
        s = self.side
        padded = np.concatenate([np.zeros(s, ids.dtype), ids, np.zeros(s, ids.dtype)])
        return np.stack([padded[s + o:s + o + len(ids)] for o in (*range(-s, 0), *range(1, s + 1))], axis=1)

    def forward(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and log-probabilities of the classes."""
        total = self.sides[0][near[:, 0]]
        for k in range(1, near.shape[1]):
            total += self.sides[k][near[:, k]]
        hidden = np.tanh(total + self.inner)
        z = hidden @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return hidden, z

    def log_likelihood(self, ids: np.ndarray) -> np.ndarray:
        """log p(word | both sides) of every position."""
        near = self.windows(ids)
        out = np.empty(len(ids))
        for i in range(0, len(ids), SLICE):
            _, z = self.forward(near[i:i + SLICE])
            part = ids[i:i + SLICE]
            out[i:i + SLICE] = z[np.arange(len(z)), self.class_of[part]] + self.share[part]
        return out

    def train(self, near: np.ndarray, ids: np.ndarray, batch: int = BATCH, rate: float = RATE) -> None:
        """One pass of minibatch gradient steps, in place."""
        target, column = self.class_of[ids], np.arange(self.sides.shape[2])
        flat = self.sides.reshape(len(self.sides), -1)
        # The more often a bucket stands in a batch, the less each occurrence moves its vectors.
        usual = np.exp(self.share) * np.exp(self.out_bias)[self.class_of] * batch
        pace = (0.1 * rate / np.sqrt(np.maximum(usual, 1.0))).astype(np.float32)
        for i in range(0, len(ids), batch):
            n, t = near[i:i + batch], target[i:i + batch]
            hidden, z = self.forward(n)
            grad = np.exp(z)
            grad[np.arange(len(t)), t] -= 1.0
            back = (grad @ self.out.T) * (1.0 - hidden * hidden)
            self.out -= (rate / len(t)) * (hidden.T @ grad)
            self.out_bias -= (rate / len(t)) * grad.sum(axis=0)
            self.inner -= (rate / len(t)) * back.sum(axis=0)
            for k in range(n.shape[1]):
                cells = (n[:, k, None] * back.shape[1] + column).ravel()
                np.subtract.at(flat[k], cells, (back * pace[n[:, k], None]).ravel())

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.sides, self.inner, self.out, self.out_bias)])

    def with_weights(self, flat: np.ndarray) -> "WindowNetwork":
        parts, at = {}, 0
        for name in ("sides", "inner", "out", "out_bias"):
            old = getattr(self, name)
            parts[name] = flat[at:at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return replace(self, **parts)


def corpus_counts(docs: DataFrame, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Occurrences of each bucket over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_worker("buckets", str(buckets), lambda: Buckets(buckets)).of
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(of(value.as_py()), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def train_network(docs: DataFrame, network: WindowNetwork, text: str = "text") -> WindowNetwork:
    """Average of the networks that the tasks train on their documents, weighted by words."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    buckets, block = network.sides.shape[1], 256

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_worker("buckets", str(buckets), lambda: Buckets(buckets)).of
        own = shared.value.with_weights(shared.value.weights().copy())
        seen, near, ids, held = 0, [], [], 0
        for batch in batches:
            for value in batch.column(0):
                found = of(value.as_py())
                if len(found):
                    near.append(own.windows(found))
                    ids.append(found)
                    held += len(found)
                if held >= SLICE:
                    own.train(np.concatenate(near), np.concatenate(ids))
                    seen, near, ids, held = seen + held, [], [], 0
        if held:
            own.train(np.concatenate(near), np.concatenate(ids))
            seen += held
        if seen:
            flat = own.weights()
            flat = np.pad(flat, (0, -len(flat) % block)).reshape(-1, block)
            fixed = np.round(np.clip(flat.astype(np.float64), -1e3, 1e3) * SCALE).astype(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(fixed.ravel()), block).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(fixed))), lists, pa.array([seen] * len(fixed), pa.int64())], ["block", "w", "n"])

    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(train, "block long, w array<long>, n long")
    parts = materialize(parts, "networks")
    words = parts.filter("block = 0").agg(F.sum("n")).first()[0]
    if not words:
        return network
    # Sums of value * words as decimals: exact in any order.
    cells = parts.select("block", "n", F.posexplode("w").alias("i", "v"))
    sums = cells.groupBy("block", "i").agg(F.sum(F.col("v").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)")).alias("s"))
    mean = sums.select((F.col("block") * block + F.col("i")).alias("at"),
                       (F.col("s").cast("double") / F.lit(float(words) * SCALE)).alias("v")).toPandas()
    flat = np.zeros(len(mean))
    flat[mean["at"].to_numpy()] = mean["v"].to_numpy()
    return network.with_weights(flat)


def fit_network(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> WindowNetwork:
    """Counts, then one training pass, over all documents."""
    return train_network(docs, WindowNetwork.start(corpus_counts(docs, buckets, text)), text)


def score_documents(docs: DataFrame, network: WindowNetwork, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_words, log_likelihood (summed) and mean_log_likelihood of every row's whole text."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    shared, buckets = docs.sparkSession.sparkContext.broadcast(network), network.sides.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_worker("buckets", str(buckets), lambda: Buckets(buckets)).of
        for batch in batches:
            sizes, sums = [], []
            for value in batch.column(1):
                ids = of(value.as_py())
                sizes.append(len(ids))
                sums.append(float(shared.value.log_likelihood(ids).sum()) if len(ids) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                                             ["key", "n_words", "log_likelihood"])

    key_type = source.schema["key"].dataType.simpleString()
    out = source.mapInArrow(score, f"key {key_type}, n_words long, log_likelihood double")
    return out.select(F.col("key").alias(key), "n_words", "log_likelihood",
                      F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood"))
