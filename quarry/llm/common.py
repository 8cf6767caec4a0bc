"""Helpers shared by the corpus operators: materialised intermediates and global running totals."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: White space of the word rules; a word is a maximal run of other characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    jvm, sc = spark._jvm, spark.sparkContext
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and whatever was
    random or order-dependent above (row ids, range boundaries) is frozen from here on.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_offsets(df: DataFrame, order: list[str], size: str, out: str = "offset") -> DataFrame:
    """Add `out`: the sum of `size` over all rows before this one in the global order of `order`.

    `order` must be unique per row. The rows are range-partitioned (ties and hot keys split by the
    later order columns), frozen with their partition number, ranked inside each partition, and the
    per-partition totals (one row per partition) give the starting points.
    """
    ranged = materialize(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn("__pid", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__pid").agg(F.sum(size).alias("__total"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__pid", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("__in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return (ranked.join(bases, "__pid").withColumn(out, F.col("__in") + F.col("__base"))
            .drop("__pid", "__in", "__base"))


_HELD: dict[str, tuple[str, object]] = {}


def per_worker(name: str, version: str, make):
    """One object per Python worker process, kept for its later tasks; a new `version` replaces it.

    Only for objects whose answers do not depend on what they have seen (bounded caches).
    """
    held = _HELD.get(name)
    if held is None or held[0] != version:
        _HELD[name] = held = (version, make())
    return held[1]
