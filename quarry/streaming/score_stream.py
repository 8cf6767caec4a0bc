"""Structured Streaming scoring: the batch scoring projection applied to a file stream.

Scoring is stateless (fit-time values are literals), so the streaming plan is the batch plan with
a streaming source; results go to a Parquet sink in the shared checkpoint folder, with the
stream's own checkpoint beside it so a restarted query resumes exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import read_table


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Stream of one table's Parquet file(s) from the table folder (schema from the batch scan)."""
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(sf_dir))


def run_to_parquet(stream: DataFrame, name: str, timeout_s: int | None = None) -> str:
    """Run a streaming DataFrame over everything available (trigger availableNow) into Parquet.

    Waits for the end, however long it takes, unless the caller sets a timeout.
    """
    spark = stream.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"
    q = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(*([] if timeout_s is None else [timeout_s]))
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return f"{base}/out"


def score_stream(spark: SparkSession, source: DataFrame, score: Callable[[DataFrame], DataFrame],
                 name: str = "score") -> DataFrame:
    """Apply a stateless scoring function to a stream, run it, and return the scored rows (batch)."""
    scored = score(source)
    if not scored.isStreaming:
        raise ValueError("source must be a streaming DataFrame")
    return spark.read.parquet(run_to_parquet(scored, name))
