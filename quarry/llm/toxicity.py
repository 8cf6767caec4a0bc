"""Toxicity scores from a subsequence string kernel machine with Nystroem landmarks.

Tokens are compared by the gap-weighted subsequence kernel: common subsequences of two and three
characters, contiguous or not, count `GAP` to the power of the length they span, so inserted
characters cost little. Landmark tokens span the feature space; a linear squared-hinge machine is
trained on tokens of labelled documents, and again with the clean tokens it scores highest. A
sentence is as toxic as its worst token, a text as its worst sentence; a logistic curve fitted on the
training documents turns that margin into a probability.

Cases: null, empty and blank texts have no token and get the score of a clearly clean margin; without
labelled documents of both classes every score is the same base rate; repeated rows are scored one by
one; label rows with a null id or label are left out, of conflicting ones the toxic one counts; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import materialize, per_worker

GAP, ORDERS = 0.6, 3
#: Characters of a landmark; tokens longer than a chunk are scored by overlapping chunks.
LANDMARK_CHARS, CHUNK = 9, 20
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 32, 8
#: Bounds of the labelled sample: documents of each class, and tokens that reach the trainer.
MAX_TOXIC, MAX_CLEAN, MAX_TOKENS = 4_000, 8_000, 6_000
CLEAN_MARGIN = -1.0
#: Log-likelihood gain from which a token counts as a sign of toxic documents.
LOG_GAIN = 12.0
_SPACED = re.compile(r"(?<!\S)\w(?:[ .*_-]\w){2,}(?!\S)")
_EDGE = re.compile(r"^\W+|\W+$")


def tokens_of(text: str | None) -> set[str]:
    """Distinct lower-case tokens, and runs of single characters read as one token."""
    low = (text or "").lower()
    found = set(low.split())
    if len(found) > 0:
        found.update(re.sub(r"\W|_", "", x) for x in _SPACED.findall(low))
    return found


def chunks_of(token: str) -> list[str]:
    """The token without marks at its ends, with a start mark, in chunks of `CHUNK` characters."""
    bare = "^" + _EDGE.sub("", token)
    if len(bare) <= CHUNK:
        return [bare]
    return [bare[i:i + CHUNK] for i in range(0, len(bare) - CHUNK // 2, CHUNK // 2)]


class SubsequenceKernel:
    """Normalised kernel values of words against fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        size = max(map(len, landmarks))
        chars = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
        self.chars = chars
        self.match = np.zeros((size, len(chars) + 1, len(landmarks)), np.float32)
        for i, mark in enumerate(landmarks):
            for j, c in enumerate(mark):
                self.match[j, chars[c], i] = 1.0
        self.decay = self._decay(size)
        self.norm = np.sqrt(self._self(landmarks))

    @staticmethod
    def _decay(size: int) -> np.ndarray:
        step = np.arange(size)[None, :] - np.arange(size)[:, None]
        return np.where(step >= 0, GAP ** (step + 2.0), 0.0).astype(np.float32)

    @staticmethod
    def _run(matches: Iterator[np.ndarray], decay: np.ndarray) -> np.ndarray:
        """matches: per character of the words, 1 where it equals a character of the other side
        (size x n x m: the other side's characters first, so that every step works on whole planes).
        Returns the kernel of each order (orders x n x m)."""
        total, before = None, None
        for match in matches:
            if total is None:
                total = np.zeros((ORDERS, *match.shape[1:]), np.float32)
                before = [np.zeros_like(match) for _ in range(ORDERS - 1)]
            for order in range(ORDERS - 1, -1, -1):
                if order:
                    ends = np.zeros_like(match)
                    np.multiply(match[1:], before[order - 1][:-1], out=ends[1:])
                else:
                    ends = match
                total[order] += GAP * GAP * ends.sum(axis=0)
                if order < ORDERS - 1:
                    before[order] *= GAP
                    before[order] += (decay.T @ ends.reshape(len(decay), -1)).reshape(ends.shape)
        return total

    def _self(self, words: list[str]) -> np.ndarray:
        size = max(map(len, words))
        codes = np.zeros((len(words), size), np.int64)
        for i, w in enumerate(words):
            codes[i, :len(w)] = [ord(c) for c in w]
        codes = codes.T.copy()
        matches = (((codes == codes[t]) & (codes[t] > 0)).astype(np.float32)[:, :, None] for t in range(size))
        return np.maximum(self._run(matches, self._decay(size))[1:, :, 0], 1e-9)

    def __call__(self, words: list[str]) -> np.ndarray:
        """n x landmarks: mean over the orders two and three of the normalised kernels."""
        out = np.empty((len(words), len(self.landmarks)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for part in (order[i:i + 192] for i in range(0, len(order), 192)):
            own = [words[i] for i in part]
            size = len(own[-1])
            codes = np.zeros((len(own), size), np.int64)
            for i, w in enumerate(own):
                codes[i, :len(w)] = [self.chars.get(c, 0) for c in w]
            raw = self._run((self.match[:, codes[:, t]] for t in range(size)), self.decay)[1:]
            norm = np.sqrt(self._self(own))
            out[part] = (raw / (norm[:, :, None] * self.norm[:, None, :])).mean(axis=0)
        return out


@dataclass
class ToxicModel:
    landmarks: list[str]
    weights: np.ndarray  # one per landmark: the trained weights times the whitening matrix
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


class MarginScorer:
    """Margins of texts; remembers the margins of at most `max_tokens` tokens."""

    def __init__(self, model: ToxicModel, max_tokens: int = 400_000):
        self.kernel, self.model, self.max_tokens = SubsequenceKernel(model.landmarks), model, max_tokens
        self.known: dict[str, float] = {}
        self.folded = self._fold()

    def _fold(self) -> list[np.ndarray]:
        """For each subsequence of two and three characters its weighted sum over the landmarks, so that
        a word's margin needs its own subsequences only, whatever the number of landmarks."""
        kernel, n = self.kernel, len(self.kernel.chars) + 1
        tables = [np.zeros((n,) * order) for order in (2, 3)]
        for i, mark in enumerate(kernel.landmarks):
            codes = [kernel.chars[c] for c in mark]
            for k, table in enumerate(tables):
                share = self.model.weights[i] / (kernel.norm[k, i] * len(tables))
                for places in itertools.combinations(range(len(mark)), k + 2):
                    table[tuple(codes[p] for p in places)] += share * GAP ** (places[-1] - places[0] + 1)
        return tables

    def word_margins(self, words: list[str]) -> np.ndarray:
        """kernel(words) @ weights + bias, by the folded weights; words of one length at a time."""
        out, lengths = np.empty(len(words)), np.array([len(w) for w in words])
        for size in np.unique(lengths):
            every = np.flatnonzero(lengths == size)
            for at in (every[i:i + 1024] for i in range(0, len(every), 1024)):
                own = [words[i] for i in at]
                codes = np.array([[self.kernel.chars.get(c, 0) for c in w] for w in own], np.int64)
                norm, total = np.sqrt(self.kernel._self(own)), np.full(len(own), self.model.bias)
                for k, table in enumerate(self.folded):
                    places = np.array(list(itertools.combinations(range(size), k + 2)), np.int64).reshape(-1, k + 2)
                    span = GAP ** (places[:, -1] - places[:, 0] + 1.0)
                    found = table[tuple(codes[:, places[:, j]] for j in range(k + 2))]
                    total += (found @ span) / norm[k]
                out[at] = total
        return out

    def token_margins(self, tokens: list[str]) -> np.ndarray:
        parts = [(i, c) for i, t in enumerate(tokens) for c in chunks_of(t)]
        values = self.word_margins([c for _, c in parts])
        out = np.full(len(tokens), -np.inf)
        np.maximum.at(out, [i for i, _ in parts], values)
        return out

    def margins(self, texts: list[str | None]) -> list[float]:
        sets = [tokens_of(t) for t in texts]
        missing = set().union(*sets).difference(self.known)
        if len(self.known) + len(missing) > self.max_tokens:
            self.known.clear()
            missing = set().union(*sets)
        if missing:
            new = sorted(missing)
            self.known.update(zip(new, self.token_margins(new).tolist(), strict=True))
        return [max(map(self.known.__getitem__, s), default=CLEAN_MARGIN) for s in sets]


def fit_machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (last one: bias) of a linear squared-hinge machine, by Newton steps on the primal."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        part = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + part.T @ x[inside], part.T @ y[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def labelled_sample(labels: DataFrame, max_toxic: int, max_clean: int) -> DataFrame:
    """(doc_id, toxic) of training rows: crc32 of the id as text is no multiple of five; at most
    `max_toxic` and `max_clean` documents, by the order of their id hashes."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    parts = [rows.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for t, n in ((1, max_toxic), (0, max_clean))]
    return parts[0].unionByName(parts[1])


def token_table(texts: DataFrame) -> DataFrame:
    """(token, n_toxic, n_clean): training documents that hold it."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, y) for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True)
                    for t in tokens_of(text.as_py())]
            words, marks = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(marks, pa.int64())], ["token", "toxic"])

    pairs = texts.select("text", F.col("toxic").cast("long")).mapInArrow(distinct, "token string, toxic long")
    return pairs.groupBy("token").agg(F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_clean"))


def one_of_copies(texts: DataFrame) -> DataFrame:
    """One training text of each lowest three-word hash: words that copies of one toxic text share are
    no sign of toxicity."""
    def lowest(words):
        at = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)))
        return F.array_min(F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    words = F.split(F.coalesce("text", F.lit("")), r"\s+")
    return texts.withColumn("low", F.transform(F.array(words), lowest)[0]).dropDuplicates(["low", "toxic"]).drop("low")


def _landmarks(candidates: list[str], wanted: int, similar: float = 0.55) -> list[str]:
    """Candidates in order, leaving out those close to one taken before."""
    taken: list[str] = []
    for start in (c[:LANDMARK_CHARS] for t in candidates for c in chunks_of(t)[:1]):
        if len(start) > 3 and (not taken or SubsequenceKernel(taken)([start]).max() < similar):
            taken.append(start)
        if len(taken) == wanted:
            break
    return taken


def _train(toxic: list[str], clean: list[str], landmarks: list[str]) -> ToxicModel:
    kernel = SubsequenceKernel(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    words = [chunks_of(t)[0] for t in toxic + clean]
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    cost = np.where(y > 0, 3000.0 / max(len(toxic), 1), 5.0)
    w = fit_machine(kernel(words) @ whiten, y, cost)
    return ToxicModel(landmarks, whiten @ w[:-1], float(w[-1]))


def _logistic(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the margin's logistic curve: Newton steps on smoothed targets, with the
    classes weighted alike."""
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, 0.5 / n1, 0.5 / n0)
    x, w = np.stack([margins, np.ones_like(margins)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (weight * (p - target)) + 1e-6 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
                 max_tokens: int = MAX_TOKENS, hard_rounds: int = 2, key: str = "doc_id", text: str = "text") -> ToxicModel:
    """The model. The labelled sample's ids are broadcast (their number is bounded), token counts stay
    in Spark, and the trainer gets at most `max_tokens` tokens per query and the sample's margins."""
    chosen = F.broadcast(materialize(labelled_sample(labels, max_toxic, max_clean), "sample"))
    texts = materialize(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
                        .join(chosen, "doc_id").select("text", "toxic"), "train")
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return ToxicModel(["^none"], np.zeros(1), CLEAN_MARGIN, 0.0, 30.0 if n1 else -3.0)
    table = materialize(token_table(one_of_copies(texts)), "tokens")
    odds = ((F.col("n_toxic") + 0.5) / (n1 + 1)) / ((F.col("n_clean") + 0.5) / (n0 + 1))
    # Gain in log-likelihood over chance: a bound that random words of a large vocabulary don't reach.
    n, share = F.col("n_toxic") + F.col("n_clean"), n1 / (n1 + n0)
    gain = F.col("n_toxic") * F.log(F.col("n_toxic") / n / share) + F.when(
        F.col("n_clean") > 0, F.col("n_clean") * F.log(F.col("n_clean") / n / (1 - share))).otherwise(0.0)
    strong = table.filter((F.col("n_toxic") >= 3) & (odds >= 8)).filter(gain >= LOG_GAIN).orderBy(gain.desc(), "token").limit(600)
    toxic = [r["token"] for r in strong.select("token").collect()]
    if not toxic:
        return ToxicModel(["^none"], np.zeros(1), CLEAN_MARGIN, 0.0, float(np.log(n1 / n0)))
    usual = table.filter((F.col("n_clean") >= 1) & (odds < 2))
    # The table is small in bytes but long to score: deal it out to all cores, whatever its file sizes.
    cores = max(table.sparkSession.sparkContext.defaultParallelism, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = usual.select("token").repartition(cores)
    clean = [r["token"] for r in usual.orderBy(F.xxhash64("token"), "token").limit(max_tokens).select("token").collect()]
    common = [r["token"] for r in usual.orderBy(F.col("n_clean").desc(), "token").limit(500).select("token").collect()]
    landmarks = _landmarks(toxic, TOXIC_LANDMARKS)
    landmarks += [x for x in _landmarks(common, CLEAN_LANDMARKS) if x not in landmarks]
    clean = list(dict.fromkeys(common + clean))
    model = _train(toxic, clean, landmarks)
    for _ in range(hard_rounds):
        margin = _margin_column(model, table.sparkSession, tokens=True)
        hard = dealt.select("token", margin("token").alias("m")).orderBy(F.col("m").desc(), "token").limit(1000)
        clean = list(dict.fromkeys(clean + [r["token"] for r in hard.collect()]))
        model = _train(toxic, clean, landmarks)
    margin = _margin_column(model, table.sparkSession)
    rows = texts.select(margin("text").alias("m"), "toxic").collect()
    model.slope, model.shift = _logistic(np.array([r["m"] for r in rows]), np.array([r["toxic"] == 1 for r in rows]))
    return model


def _margin_column(model: ToxicModel, spark: SparkSession, tokens: bool = False):
    shared, version = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("double")
    def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = per_worker("toxicity", version, lambda: MarginScorer(shared.value))
        for texts in batches:
            if tokens:
                yield pd.Series(scorer.token_margins(texts.tolist()))
            else:
                parts = (texts.iloc[i:i + 200].tolist() for i in range(0, len(texts), 200))
                yield pd.Series([m for part in parts for m in scorer.margins(part)], dtype=float)

    return margin


def score_toxicity(docs: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, margin, score and predicted of every row's whole text. No shuffle."""
    margin = _margin_column(model, docs.sparkSession)
    z = F.least(F.greatest(F.lit(model.slope) * F.col("margin") + F.lit(model.shift), F.lit(-30.0)), F.lit(30.0))
    scored = docs.select(F.col(f"`{key}`").alias(key), margin(F.col(f"`{text}`")).alias("margin"))
    return scored.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
