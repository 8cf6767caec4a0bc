"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    """Session used by tests and the bench. On a cluster the launcher supplies its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a private scratch folder. On a cluster a folder
    of the driver's own disk is of no use to the executors, so a missing setting raises.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if current.startswith("/"):
        os.makedirs(current, exist_ok=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_table(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write `df` as Parquet to the shared checkpoint folder, split by the columns `by`, and read it back;
    the folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_DROPPING = threading.Lock()
_INSIDE: list[str | None] = []      # the setting that each thread inside `shuffles_dropped` found


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends, not when the driver next collects
    garbage. For queries whose result is written and that nothing runs again. Threads share the setting: the first
    one in makes it, the last one out takes it back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _DROPPING:
        _INSIDE.append(_INSIDE[0] if _INSIDE else spark.conf.get(name, None))
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _DROPPING:
            before = _INSIDE.pop()
            if not _INSIDE and before is None:
                spark.conf.unset(name)
            elif not _INSIDE:
                spark.conf.set(name, before)


ROWS_PER_PARTITION = 1_000_000


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Merge partitions (no shuffle) down to about `rows_per_partition` rows each, but never below the
    cluster's default parallelism.

    Iterative fits run one job per pass over a cached frame; on a small frame, many tiny partitions
    cost more in task overhead than they add in parallelism. Large frames keep their partitions.
    """
    target = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // rows_per_partition))
    return df.coalesce(target) if df.rdd.getNumPartitions() > target else df
