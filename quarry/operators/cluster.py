"""k-means clustering (K1-K6) with Spark ML on standardized inputs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import right_size

FEATURES = "features"
#: Rows from which the shared iterations are spread over another task.
TASK_ROWS = 1 << 14
#: Share by which costs of one optimum differ when they are summed in another order.
ROUNDING = 1e-11


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def fit_kmeans(df: DataFrame, k: int, seed: int = 1, max_iter: int = 100, init_mode: str = "random"):
    """Lloyd iterations from k randomly drawn rows (the reference's random starts); one Spark job
    per iteration over the cached features. `init_mode="k-means||"` gives Spark's seeding."""
    return KMeans(k=k, seed=seed, maxIter=max_iter, initMode=init_mode, featuresCol=FEATURES,
                  predictionCol="cluster").fit(df)


def multistart(df: DataFrame, k: int, seeds: Sequence[int], max_iter: int = 100, parallel: int = 4,
               init_mode: str = "random"):
    """Fit once per seed and keep the lowest within-cluster sum of squares (nstart).

    All starts move together, one job an iteration for all of them (`_lloyd_costs`). Starts within rounding of the
    lowest cost are fitted by Spark from the same centres, and the lowest of these is returned; ties in cost go to
    the earlier seed."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        best = list(seeds)
        if len(best) > 1:
            # No iteration: the seed's starting centres.
            starts = list(pool.map(lambda s: np.array(fit_kmeans(data, k, s, 0, init_mode).clusterCenters()), best))
            costs = _lloyd_costs(data, starts, max_iter)
            best = [s for s, c in zip(best, costs) if not c > min(costs) * (1 + ROUNDING)]

        def one(s):
            m = fit_kmeans(data, k, s, max_iter, init_mode)
            return m, m.summary.trainingCost, s

        fits = list(pool.map(one, best))
    return min(fits, key=lambda f: (f[1], list(seeds).index(f[2])))


def _lloyd_costs(data: DataFrame, starts: Sequence[np.ndarray], max_iter: int, tol: float = 1e-4) -> list[float]:
    """Cost of Lloyd iterations from each of `starts`, as Spark's k-means counts it: that of the last iteration's
    assignment, after which no centre moved by more than `tol`. Centres without rows stay.

    Rows are packed once; a task adds up, for every start that still moves, rows, sums and cost by centre, so the
    driver gets a few numbers a centre from each task."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                                             ["n", "x"])

    n_rows, cores = data.count(), data.sparkSession.sparkContext.defaultParallelism
    rows = right_size(data.select(vector_to_array(FEATURES).alias("x")), n_rows)
    if rows.rdd.getNumPartitions() < min(cores, n_rows // TASK_ROWS):  # a small view lies in one or two files
        rows = rows.repartition(min(cores, n_rows // TASK_ROWS))
    blocks = rows.mapInArrow(pack, "n int, x binary").persist(StorageLevel.MEMORY_AND_DISK)
    centres, costs, running = [c.copy() for c in starts], [0.0] * len(starts), set(range(len(starts)))

    def add_up(now: dict[int, np.ndarray]):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x = np.frombuffer(x).reshape(n, -1)
                    size = (x * x).sum(axis=1)
                    for start, c in now.items():
                        far = (c * c).sum(axis=1) - 2.0 * (x @ c.T)
                        at = far.argmin(axis=1)
                        cost = np.maximum(far[np.arange(n), at] + size, 0.0)
                        found = np.stack([np.bincount(at, w, len(c)) for w in (None, cost, *x.T)], axis=1)
                        sums[start] = sums[start] + found if start in sums else found
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                                  pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                                 ["start", "sums"])
        return task

    try:
        for _ in range(max_iter):
            found: dict[int, np.ndarray] = {}
            for r in blocks.mapInArrow(add_up({i: centres[i] for i in running}), "start int, sums binary").collect():
                part = np.frombuffer(r["sums"]).reshape(len(centres[r["start"]]), -1)
                found[r["start"]] = found[r["start"]] + part if r["start"] in found else part
            for i, total in found.items():
                have = total[:, 0] > 0
                new = centres[i].copy()
                new[have] = total[have, 2:] / total[have, :1]
                costs[i] = float(total[:, 1].sum())
                if (((new - centres[i]) ** 2).sum(axis=1) <= tol * tol).all():
                    running.discard(i)
                centres[i] = new
            if not found or not running:
                break
    finally:
        blocks.unpersist()
    return costs


def total_ss(df: DataFrame, cols: Sequence[str]) -> float:
    """Within-cluster SS of the single cluster k=1: sum over columns of (n - 1) * variance."""
    row = df.agg(*[((F.count(c) - 1) * F.var_samp(c)).alias(c) for c in cols]).first()
    return float(sum(row[c] or 0.0 for c in cols))


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 1, max_iter: int = 100,
          n_starts: int = 1, parallel: int = 8, init_mode: str = "k-means||") -> list[tuple[int, float]]:
    """(k, WCSS) per k; k = 1 is the total sum of squares (Spark's k-means needs k >= 2).

    Each k starts from k-means|| seeding: far fewer Lloyd passes than random rows at any scale."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)

    def one(k):
        if k == 1:
            return 1, total_ss(data, cols)
        _, cost, _ = multistart(data, k, [seed + i for i in range(n_starts)], max_iter, parallel=1,
                                init_mode=init_mode)
        return k, float(cost)

    # One fit per k, independent of each other: run several at once.
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, ks))


def profile(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Per cluster: size, mean of each input and its gap to the overall mean in overall sds."""
    overall = assigned.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                           *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs.append(F.avg(c).alias(f"mean_{c}"))
    per = assigned.groupBy(cluster).agg(*aggs)
    for c in cols:
        per = per.withColumn(f"gap_{c}", F.try_divide(F.col(f"mean_{c}") - F.lit(overall[f"m_{c}"]),
                                                     F.lit(overall[f"s_{c}"]).cast("double")))
    return per


def project_2d(df: DataFrame, features: str = FEATURES) -> DataFrame:
    """First two principal-component coordinates of each row (the data behind a cluster plot)."""
    model = PCA(k=2, inputCol=features, outputCol="__pc").fit(df)
    out = model.transform(df).withColumn("__a", vector_to_array("__pc"))
    return out.withColumn("pc1", F.col("__a")[0]).withColumn("pc2", F.col("__a")[1]).drop("__pc", "__a")
