"""Feed-forward classifier with tanh hidden layers and one sigmoid output, trained by adam on
synchronous mini-batches, with early stopping on validation rows (N1-N4, S5).

The training rows are packed once into blocks of a few thousand rows, dealt to `steps` slices by a hash
of the row key. One step is one job over one slice: tasks sum the gradients of their blocks in numpy and
Spark adds the sums by weight position, so the driver sees a bounded number of sums whatever the number of
rows or tasks, and a network does not depend on how the blocks are spread over tasks. The optimizer's
state (two moments per weight) stays on the driver. Scoring is a projection of built-in functions.

Cases: rows with a NULL or non-finite input, or a target other than 0 and 1, take no part in training and
validation and get a NULL score; an input that is constant in training counts as 0; repeated rows count as
often as they occur; without a usable training or validation row `fit_network` raises ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import named
from quarry.session import scratch_table

#: Rows of one packed block, and the fixed point of summed gradients.
BLOCK, SCALE = 1 << 14, 1 << 24
#: Rows that make a task of a step, and tasks whose sums the driver adds itself (exact, so the same either way).
TASK_ROWS, FEW_TASKS = 1 << 16, 64
# Moments and denominator of the optimizer (fixed values of the published method).
DECAY_1, DECAY_2, EPSILON = 0.9, 0.999, 1e-7


@dataclass
class Network:
    """`sizes`: inputs, hidden units ..., 1; `flat`: per layer the weights (from x to), then the biases."""

    inputs: list[str]
    sizes: list[int]
    center: list[float]
    spread: list[float]
    flat: list[float]

    def transform(self, df: DataFrame, out: str = "pred_prob", prefix: str = "") -> DataFrame:
        """`df` and the probability of class 1, read from the columns `prefix` + input; no action."""
        keep, layer = list(df.columns), _free_name(df.columns, "__layer")
        values = [named(prefix + c).cast("double") for c in self.inputs]
        known = F.lit(True)
        for v in values:
            known = known & F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False))
        rows = df.withColumn(layer, F.when(known, F.array(*[(v - F.lit(m)) / F.lit(s) for v, m, s in zip(
            values, self.center, self.spread)])))
        parts = unpack(np.array(self.flat), self.sizes)
        for w, b in parts[:-1]:
            rows = rows.withColumn(layer, _units(F.col(layer), w, b, F.tanh))
        logit = F.get(_units(F.col(layer), *parts[-1], lambda z: z), F.lit(0))
        return rows.select(*map(named, [c for c in keep if c != out]), (1 / (1 + F.exp(-logit))).alias(out))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Network":
        return Network(**json.loads(text))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "params string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Network":
        return Network.from_json(spark.read.text(path).first()[0])


def _free_name(columns: Sequence[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _units(values: Column, weights: np.ndarray, biases: np.ndarray, apply: Callable[[Column], Column]) -> Column:
    """Array of a layer's units. `values` stands in it once, so that a filter on the score, which Catalyst
    pushes down by putting the expressions into each other, stays as long as the network is."""
    units = F.array(*[F.struct(F.array(*[F.lit(float(v)) for v in weights[:, j]]).alias("w"),
                               F.lit(float(biases[j])).alias("b")) for j in range(len(biases))])
    return F.transform(units, lambda unit: apply(F.aggregate(
        F.zip_with(values, unit["w"], lambda x, w: x * w), unit["b"], lambda total, x: total + x)))


def unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, biases) of every layer as views of the flat vector."""
    parts, at = [], 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        w = flat[at:at + n_in * n_out].reshape(n_in, n_out)
        at += n_in * n_out
        parts.append((w, flat[at:at + n_out]))
        at += n_out
    return parts


def start_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights within sqrt(6 / (inputs + outputs)) of a layer, biases 0."""
    rng = np.random.default_rng(seed)
    flat = []
    for n_in, n_out in zip(sizes, sizes[1:]):
        bound = np.sqrt(6.0 / (n_in + n_out))
        flat += [rng.uniform(-bound, bound, n_in * n_out), np.zeros(n_out)]
    return np.concatenate(flat)


def forward(x: np.ndarray, flat: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Values of every layer; the last is the logit of class 1."""
    values = [x]
    parts = unpack(flat, sizes)
    for k, (w, b) in enumerate(parts):
        z = values[-1] @ w + b
        values.append(np.tanh(z) if k < len(parts) - 1 else z)
    return values


def losses(x: np.ndarray, y: np.ndarray, flat: np.ndarray, sizes: Sequence[int]) -> tuple[float, int]:
    """Summed cross-entropy and the number of rows on the right side of 0.5."""
    z = forward(x, flat, sizes)[-1][:, 0]
    return float((np.logaddexp(0.0, z) - y * z).sum()), int(((z > 0) == (y > 0.5)).sum())


def gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Gradient of the summed cross-entropy."""
    values, parts = forward(x, flat, sizes), unpack(flat, sizes)
    back = 1.0 / (1.0 + np.exp(-np.clip(values[-1], -500, 500))) - y[:, None]
    pieces: list[np.ndarray] = []
    for k in range(len(parts) - 1, -1, -1):
        pieces = [(values[k].T @ back).ravel(), back.sum(axis=0), *pieces]
        if k:
            back = (back @ parts[k][0].T) * (1.0 - values[k] * values[k])
    return np.concatenate(pieces)


def _usable(df: DataFrame, inputs: Sequence[str], target: str) -> DataFrame:
    """The rows that can be learned from, as an array of doubles `x` and a target `y`."""
    x = [named(c).cast("double") for c in inputs]
    y = named(target).cast("double")
    fine = y.isin(0.0, 1.0)
    for v in x:
        fine = fine & (F.abs(v) < F.lit(float("inf")))
    return df.filter(F.coalesce(fine, F.lit(False)))


def _moments(rows: DataFrame, inputs: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Rows, means and sample deviations (1 where they are 0 or undefined): one aggregate."""
    aggs = [F.count(F.lit(1))]
    for c in inputs:
        aggs += [F.avg(named(c).cast("double")), F.stddev_samp(named(c).cast("double"))]
    row = rows.agg(*[a.alias(str(i)) for i, a in enumerate(aggs)]).first()
    return row[0], [row[i] or 0.0 for i in range(1, len(row), 2)], [row[i] or 1.0 for i in range(2, len(row), 2)]


def _pack(rows: DataFrame, inputs: Sequence[str], target: str, center, spread, slice_of: Column) -> DataFrame:
    """(slice, n, x, y): standardized doubles of up to BLOCK rows, as bytes."""
    mean, sd, width = np.array(center), np.array(spread), len(inputs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = pa.Table.from_batches(held)
            number = part.column(0).to_numpy()
            y = part.column(1).to_numpy()
            x = part.column(2).combine_chunks().flatten().to_numpy().reshape(-1, width)
            x = (x - mean) / sd
            for s in np.unique(number):
                own = number == s
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([int(own.sum())], pa.int32()),
                     pa.array([x[own].tobytes()]), pa.array([y[own].astype(np.float64).tobytes()])], ["slice", "n", "x", "y"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                yield from blocks(held)
                held, size = [], 0
        if size:
            yield from blocks(held)

    flat = rows.select(slice_of.cast("int").alias("slice"), named(target).cast("double").alias("y"),
                       F.array(*[named(c).cast("double") for c in inputs]).alias("x"))
    return flat.mapInArrow(pack, "slice int, n int, x binary, y binary")


def _merged(blocks: DataFrame, n_rows: int) -> tuple[DataFrame, bool]:
    """The blocks in tasks of TASK_ROWS rows at least, and whether these are few."""
    have, want = blocks.rdd.getNumPartitions(), -(-n_rows // TASK_ROWS)
    return (blocks.coalesce(want) if want < have else blocks), min(have, want) <= FEW_TASKS


def _over_blocks(part: tuple[DataFrame, bool], work: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of what `work` returns for a block: fixed point, so in any order the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, x, y in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = work(np.frombuffer(x).reshape(n, width), np.frombuffer(y))
                fixed = np.round(part * SCALE).astype(np.int64)
                total = fixed if total is None else total + fixed
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "s"])

    blocks, few = part
    sums = blocks.mapInArrow(run, "at long, s long")
    if not few:
        sums = sums.groupBy("at").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    total: dict[int, int] = {}
    for at, s in sums.collect():
        total[at] = total.get(at, 0) + int(s)
    return np.array([total[at] for at in range(len(total))], float) / SCALE


def fit_network(train: DataFrame, valid: DataFrame, target: str, key: str, inputs: Sequence[str], hidden: Sequence[int],
                epochs: int = 40, patience: int | None = 5, monitor: str = "loss", steps: int = 8, rate: float = 0.03,
                seed: int = 1, checkpoint_path: str | None = None):
    """(best network, history [(epoch, validation loss, validation accuracy)], best epoch).

    An epoch takes `steps` optimizer steps, one per slice of the training rows, in an order of its own.
    Training ends after `patience` epochs whose `monitor` ("loss" or "accuracy" of the validation rows) is
    no better than the best so far (None: never), or after `epochs`; the best epoch's weights are returned,
    and saved to `checkpoint_path` whenever they improve."""
    if monitor not in ("loss", "accuracy"):
        raise ValueError("monitor is 'loss' or 'accuracy'")
    inputs, spark = list(inputs), train.sparkSession
    sizes = [len(inputs), *hidden, 1]
    usable, checked = _usable(train, inputs, target), _usable(valid, inputs, target)
    n, center, spread = _moments(usable, inputs)
    if not n:
        raise ValueError("no usable training row")
    slice_of = F.pmod(F.xxhash64(named(key), F.lit(seed)), F.lit(steps))
    blocks = scratch_table(_pack(usable, inputs, target, center, spread, slice_of), "network-train", ["slice"])
    held = scratch_table(_pack(checked, inputs, target, center, spread, F.lit(0)), "network-valid")
    counts = {r["slice"]: r["n"] for r in blocks.groupBy("slice").agg(F.sum("n").alias("n")).collect()}
    n_valid = held.agg(F.sum("n")).first()[0]
    if not n_valid:
        raise ValueError("no usable validation row")
    slices = {s: _merged(blocks.filter(F.col("slice") == s).select("n", "x", "y"), n_s) for s, n_s in counts.items()}
    held = _merged(held.select("n", "x", "y"), n_valid)

    width, rng = len(inputs), np.random.default_rng(seed)
    flat = start_weights(sizes, seed)
    first, second, taken = np.zeros_like(flat), np.zeros_like(flat), 0
    history, best, stale = [], None, 0
    for epoch in range(1, epochs + 1):
        for s in rng.permutation(steps):
            if int(s) not in counts:
                continue
            grad = _over_blocks(slices[s], lambda x, y, now=flat: gradient(x, y, now, sizes), width) / counts[int(s)]
            taken += 1
            first = DECAY_1 * first + (1 - DECAY_1) * grad
            second = DECAY_2 * second + (1 - DECAY_2) * grad * grad
            pace = rate * np.sqrt(1 - DECAY_2 ** taken) / (1 - DECAY_1 ** taken)
            flat = flat - pace * first / (np.sqrt(second) + EPSILON)
        loss, right = _over_blocks(held, lambda x, y, now=flat: np.array(losses(x, y, now, sizes), float), width) / n_valid
        history.append((epoch, float(loss), float(right)))
        score = loss if monitor == "loss" else -right
        if best is None or score < best[0]:
            best, stale = (score, epoch, flat), 0
            network = Network(inputs, sizes, center, spread, [float(v) for v in flat])
            if checkpoint_path:
                network.save(spark, checkpoint_path)
        else:
            stale += 1
            if patience is not None and stale >= patience:
                break
    if checkpoint_path:
        network = Network.load(spark, checkpoint_path)
    return network, history, best[1]


def evaluate(network: Network, df: DataFrame, target: str) -> tuple[float, float]:
    """(cross-entropy, accuracy) of the rows with a score and a target: one aggregate."""
    p = F.least(F.greatest(F.col("__p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    y = named(target).cast("double")
    row = network.transform(df, "__p").agg(
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))), F.avg((y == (F.col("__p") > 0.5).cast("double")).cast("double"))).first()
    return row[0], row[1]
