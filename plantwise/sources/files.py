"""File sources and sinks (CSV, parquet) for the medallion layers.

Directory listing and CSV header peeking happen on the driver through the
Hadoop FileSystem API (metadata only: one glob and one header line per
file); all data is read by executors.
"""

from __future__ import annotations

import csv
import os
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs_and_paths(spark: SparkSession, pattern: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    stats = fs.globStatus(path)
    files = [] if stats is None else [s.getPath().toString() for s in stats if s.isFile()]
    return fs, jvm, sorted(files)


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    return _fs_and_paths(spark, pattern)[2]


def _header(fs, jvm, file: str) -> tuple[str, ...]:
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(file))
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), []))


def load_csv_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All CSV files of a glob, unioned by column name (missing -> null).

    Files are grouped by header so each group is one scan; no files gives an
    empty table (no columns), not an error.  Values stay text; the silver
    transforms parse them leniently.
    """
    fs, jvm, files = _fs_and_paths(spark, pattern)
    if not files:
        return spark.createDataFrame([], T.StructType([]))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=16) as pool:   # one small read per file
        headers = list(pool.map(lambda f: _header(fs, jvm, f), files))
    for f, h in zip(files, headers):
        groups[h].append(f)
    frames = []
    for header, paths in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        frames.append(spark.read.option("header", True).option("mode", "PERMISSIVE")
                      .schema(schema).csv(paths))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV with header and inferred types (exploration only: inference
    costs an extra pass over the file)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Reader chosen by extension: .csv (text columns) or parquet."""
    if path.lower().endswith(".csv"):
        return spark.read.csv(path, header=True)
    return spark.read.parquet(path)


def write_layer(df: DataFrame, base_dir: str, domain: str,
                partition_by: list[str] | None = None) -> str:
    """Overwrite ``<base_dir>/<domain>`` with the frame as parquet."""
    out = os.path.join(base_dir, domain)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out)
    return out


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header; vector / array / map / struct columns are dropped or
    serialised (CSV holds flat text only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        elif f.dataType.typeName() == "vector":
            continue
        else:
            cols.append(F.col(f.name))
    df.select(*cols).write.mode(mode).option("header", True).csv(path)
    return path


def parquet_to_csv(spark: SparkSession, src: str, dst: str) -> str:
    return write_csv(spark.read.parquet(src), dst)


def load_with_fallback(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame:
    """Parquet when it exists, else the CSV copy."""
    fs, _, files = _fs_and_paths(spark, parquet_path)
    if files or _exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    return spark.read.csv(csv_path, header=True, inferSchema=True)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_projected(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Parquet scan with an explicit projection (pruned ``ReadSchema``)."""
    return spark.read.parquet(path).select(*cols)


def synthetic_features(spark: SparkSession, columns: list[str] | None = None,
                       n_samples: int = 100, seed: int = 42) -> DataFrame:
    """Standard-normal feature frame for smoke-testing a scoring pipeline
    (10 columns ``feature_i`` when none are given)."""
    columns = columns or [f"feature_{i}" for i in range(10)]
    return spark.range(n_samples).select(*[F.randn(seed + i).alias(c)
                                           for i, c in enumerate(columns)])
