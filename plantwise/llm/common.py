"""Helpers that the operators of this subpackage share.

Row identity.  A document is identified by ``(doc_id, hash of its text)``, so
null ids, repeated ids with different texts and fully repeated rows all have a
defined meaning: repeated rows are separate occurrences that get the same
answer.  Operators select the columns they need under private names first, so
extra columns of the input, whatever they are called, never clash.
"""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step inside a task works on at a time.
STEP_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and Python.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_key`` (hash of the text) and ``_text`` (null: empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text"))


def whole_rows(docs: DataFrame) -> DataFrame:
    """Every row as the one column ``_doc``: helpers beside it can't clash with
    the columns inside, and ``_doc.*`` gives the row back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))


def same_doc(a: DataFrame, b: DataFrame):
    """Null-safe equality of the row identity."""
    return a["_id"].eqNullSafe(b["_id"]) & (a["_key"] == b["_key"])


class Stages:
    """Tables written between the jobs of one operator run.

    They live in the folder that all executors share
    (``spark.checkpoint.dir``), so a lost executor costs only its running
    tasks.  ``drop`` removes a table that no later job reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with small_batches(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``BATCH_BYTES`` while a job runs: JVM and Python hold
    each batch several times, and texts differ in length by 10^5."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs now: it
    waits for the driver's garbage collection, which a small driver heap may
    not need for hours."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_fs(path: str):
    """(pyarrow filesystem, path inside it) of a folder URI that executors share."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = STEP_BYTES):
    """Consecutive slices of a batch holding about ``limit`` bytes of a string
    column each, one row at least."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    step = (np.cumsum(size, dtype=np.int64) - size) // limit
    cuts = np.flatnonzero(np.diff(step)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, n]):
        yield batch.slice(int(a), int(b - a))


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + l)`` for every pair."""
    lens = np.asarray(lens, dtype=np.int64)
    total = int(lens.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lens), lens)


