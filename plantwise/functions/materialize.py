"""Cutting lineage between pipeline stages.

Multi-pass operators (group statistics joined back, quantiles) reference
their input several times; chaining many of them over an unmaterialised
lineage makes plans (and recomputation after a lost executor) grow with the
depth.  ``materialize`` writes the frame once as parquet into the cluster's
shared ``spark.checkpoint.dir`` -- never a node-local folder, never
``localCheckpoint`` -- and reads it back, so later stages scan compact
columnar files (with statistics for adaptive planning) and survive executor
loss.  A parquet write is one job; ``Dataset.checkpoint`` would compute the
lineage twice (once to count, once to write) unless it was cached.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from plantwise.session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "plantwise-materialized", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_all(frames: dict[str, DataFrame], max_workers: int = 4) -> dict[str, DataFrame]:
    """Materialise independent frames as concurrent Spark jobs (a small
    driver thread pool; the jobs share the cluster's task slots)."""
    from concurrent.futures import ThreadPoolExecutor
    if len(frames) <= 1:
        return {k: materialize(v, k) for k, v in frames.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(frames))) as pool:
        futures = {k: pool.submit(materialize, v, k) for k, v in frames.items()}
        return {k: f.result() for k, f in futures.items()}
